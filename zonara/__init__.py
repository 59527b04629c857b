"""zonara: zonal raster analytics, wide-table series and corpus work as Spark jobs."""
