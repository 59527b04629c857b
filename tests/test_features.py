"""Boundary files line by line, against the reader of whole documents."""

import json

import pytest

from zonara import sources


def feature(k, name=None):
    ring = [[k + x / 7, k - y / 3] for x, y in ((0, 0), (1, 5), (4, 2), (0, 0))]
    return {"type": "Feature", "properties": {"NOMGEO": name or f"zone {k}", "note": ["]}, {", "a \"quoted\" {brace", "[1, 2]}"][k % 3], "list": [1, {"a": [2]}]}, "geometry": {"type": "Polygon" if k % 5 else "Point", "coordinates": [ring, ring[::-1]] if k % 5 else None}}


HEAD = ['{', '"type": "FeatureCollection",', '"name": "limits {of} [zones]",', '"crs": { "type": "name", "properties": { "name": "urn:ogc:def:crs:OGC:1.3:CRS84" } },', '"features": [']
ALL = [feature(k) for k in range(300)] + [feature(7, "Tláhuac"), feature(8, "Tláhuac")]


def texts():
    each = [json.dumps(f, ensure_ascii=False) for f in ALL]
    by_line = "\n".join([*HEAD, ",\n".join(each), "]", "}"])
    tail = each[:-1] + [json.dumps(ALL[-1] | {"bbox": [1, 2]}, ensure_ascii=False)]
    return {
        "a line each": by_line,
        "marked, with returns": "\ufeff" + by_line.replace("\n", "\r\n"),
        "all in one line": json.dumps({"type": "FeatureCollection", "features": ALL}, ensure_ascii=False),
        "frame on the same lines": '{"type": "FeatureCollection", "features": [' + ",\n".join(tail) + "]}",
        "several a line, blank lines": '{"features": [\n\n' + "".join(e + ("," if k + 1 < len(each) else "") + ("\n\n" if k % 4 == 3 else " ") for k, e in enumerate(each)) + "\n] }\n",
        "members after": '{"features": [\n' + ",\n".join(tail) + '\n], "name": "x"}',
    }


@pytest.mark.parametrize("name", list(texts()))
def test_lines_equal_the_document(spark, tmp_path, name):
    path = str(tmp_path / "f.json")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(texts()[name])
    want = [(k, f["properties"]["NOMGEO"], f["geometry"]["type"], f["geometry"]["coordinates"]) for k, f in enumerate(ALL)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = sources.features_by_line(spark, path)
        assert [tuple(r) for r in got.orderBy("ord").collect()] == want
        if "one" not in name:
            assert spark.read.text(path).rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    if "marked" not in name:
        assert [tuple(r) for r in sources.features(spark, path).orderBy("ord").collect()] == want


def test_features_over_lines_are_an_error(spark, tmp_path):
    path = str(tmp_path / "f.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"type": "FeatureCollection", "features": ALL[:3]}, f, indent=1)
    with pytest.raises(Exception, match="not whole features"):
        sources.features_by_line(spark, path).collect()
    assert sources.features(spark, path).count() == 3
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"type": "FeatureCollection", "features": []}')
    assert sources.features_by_line(spark, path).count() == 0
