"""Layers by name: the whole processing API on relations of a session."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs
from ..functions import geometry as G
from ..operators import attributes as A
from ..operators import checks as C
from ..operators import relations as R
from ..operators import union as U
from ..operators.overlay import overlay_intersection


class LayerCatalog:
    """Named layers. Results become tables, or views with ``as_view=True``.

    A result without a name of its own replaces the layer it was computed from.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def add(self, name: str, df: DataFrame, as_view: bool = False) -> DataFrame:
        return R.create_relation(df, name, as_view)

    def _replace(self, name: str, df: DataFrame) -> DataFrame:
        """Write next to the old relation, then let the new one take its name."""
        if any(t.name == name and t.isTemporary for t in self.spark.catalog.listTables()):
            return R.replace_relation(df, name)
        tmp = f"{name}_tmp"
        R.create_relation(df, tmp)
        self.drop_relations("TABLE", [name])
        self.spark.sql(f"ALTER TABLE `{tmp}` RENAME TO `{name}`")
        return self.spark.table(name)

    # ------------------------------------------------------------------ facts

    def get_srid(self, name: str) -> int | None:
        return C.layer_srid(self.table(name))

    def is_same_srid(self, a: str, b: str) -> bool:
        return C.same_srid(self.table(a), self.table(b))

    def get_geometry_types(self, name: str) -> tuple[str, ...]:
        """At most six names, whatever the size of the layer."""
        return tuple(sorted(r["type"] for r in C.geometry_types(self.table(name)).collect()))

    def map_geometry_type(self, name: str, allow_multi: bool = True) -> str | None:
        return C.single_type(self.table(name), allow_multi=allow_multi)

    # ------------------------------------------------------------------ updates

    def delete_like(self, name: str, column: str, pattern: str) -> DataFrame:
        return self._replace(name, A.delete_like(self.table(name), column, pattern))

    def singlepart_to_multipart(self, name: str) -> DataFrame:
        return self._replace(name, self.table(name).withColumn("geom", G.to_multi("geom")))

    def project_geometry(self, name: str, srid: int = G.TARGET_SRID) -> DataFrame:
        self.map_geometry_type(name)
        return self._replace(name, crs.project(self.table(name), srid))

    def project_3d_to_2d(self, name: str, srid: int = G.TARGET_SRID) -> DataFrame:
        self.map_geometry_type(name)
        return self._replace(name, crs.project_3d_to_2d(self.table(name), srid))

    def median_fill(self, name: str, value: str, group: str) -> DataFrame:
        return self._replace(name, A.median_fill(self.table(name), value, group))

    # ------------------------------------------------------------------ results

    def intersect_geometries(
        self, a: str, b: str, fields_a: Sequence[str] = (), fields_b: Sequence[str] = (), as_view: bool = False,
        out_name: str | None = None, key_a: Sequence[str] | None = None, key_b: Sequence[str] | None = None,
    ) -> DataFrame:
        out = overlay_intersection(self.table(a), self.table(b), fields_a, fields_b, key_a, key_b)
        return self._replace(b, out) if out_name is None else self.add(out_name, out, as_view)

    def dissolve_geometries(self, a: str, b: str, out_name: str, as_view: bool = False) -> DataFrame:
        out = U.dissolve_polygons(self.table(a), self.table(b)).select(F.monotonically_increasing_id().alias("id"), "geom")
        return self.add(out_name, out, as_view)

    def _union(self, reg: DataFrame, out_name: str, as_view: bool) -> DataFrame:
        """A union as the polygons it consists of, not as one value."""
        out = U.assemble(reg).select(F.monotonically_increasing_id().alias("id"), "geom")
        return self.add(out_name, out, as_view)

    def create_union(self, layer: str, out_name: str, as_view: bool = False) -> DataFrame:
        return self._union(U.region(self.table(layer)), out_name, as_view)

    def create_union_where_equals(self, layer: str, out_name: str, column: str, value, as_view: bool = False) -> DataFrame:
        return self._union(U.union_where_equals(self.table(layer), column, value), out_name, as_view)

    def create_union_where_like(self, layer: str, out_name: str, column: str, pattern: str, as_view: bool = False) -> DataFrame:
        return self._union(U.union_where_like(self.table(layer), column, pattern), out_name, as_view)

    def create_union_buffer(self, layer: str, out_name: str, radius: str, as_view: bool = False) -> DataFrame:
        return self._union(U.union_buffer(self.table(layer), radius), out_name, as_view)

    # ------------------------------------------------------------------ SQL

    def execute_query(self, mode: str, query: str, **args) -> DataFrame:
        return R.run_sql(self.spark, mode, query, **args)

    def drop_relations(self, kind: str, names: Iterable[str]) -> None:
        R.drop_relations(self.spark, kind, names)
