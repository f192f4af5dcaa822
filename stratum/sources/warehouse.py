"""The warehouse: gold tables and analyst views in named catalog schemas, and a manifest that outlives the catalog.

``publish`` registers each written gold table as an external table of the ``gold`` schema (no copy: the files stay in
the lake) and creates the analyst views as persistent views of the ``analytics`` schema, so every session over the same
metastore reads ``analytics.v_monthly_revenue`` by name. The statements are also written to the lake as a manifest;
``attach`` replays it in an application whose catalog does not know the lake yet (no metastore, or another one).

Registering is repeatable: a table whose columns and layout have not changed is refreshed, one that has changed is
registered anew (its files are not touched), and a schema that already holds another lake's table of that name is refused.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import TableStore, _same_path

MANIFEST = ("warehouse", "manifest")
MANIFEST_SCHEMA = "seq int, kind string, name string, location string, columns string, ddl string"


@dataclass(frozen=True)
class Layout:
    """How a table's files are arranged: Hive partition columns, and hash buckets."""
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0

    def clauses(self) -> str:
        out = f" PARTITIONED BY ({', '.join(map(_quoted, self.partition_by))})" if self.partition_by else ""
        if self.bucket_by:
            keys = ", ".join(map(_quoted, self.bucket_by))
            out += f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS"
        return out


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class Warehouse:
    """The catalog face of one lake. ``views`` maps a view's name to its SQL, in which ``{gold}`` stands for the schema
    of the tables; a view is created when every table it names has been published."""
    store: TableStore
    gold_schema: str = "gold"
    analytics_schema: str = "analytics"

    def publish(self, spark: SparkSession, tables: dict[str, Layout], views: dict[str, str]) -> dict[str, list[str]]:
        """Register ``tables`` (written to the store's gold layer) and create the views over them; both, and the
        manifest, replace what an earlier publish of this lake has left."""
        rows = []
        for name, layout in tables.items():
            df = spark.read.parquet(self.store.path("gold", name))
            stored = [f for f in df.schema.fields if f.name not in layout.partition_by]
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in
                                stored + [df.schema[p] for p in layout.partition_by])
            full = f"{self.gold_schema}.{_quoted(name)}"
            rows.append(("table", full, self.store.path("gold", name), columns + layout.clauses(),
                         f"CREATE TABLE {full} ({columns}) USING parquet{layout.clauses()} "
                         f"LOCATION {_text(self.store.path('gold', name))}"))
        for name, sql in views.items():
            if all(t in tables for t in _tables_of(sql)):
                full = f"{self.analytics_schema}.{_quoted(name)}"
                text = sql.replace("{gold}", self.gold_schema)
                rows.append(("view", full, None, None, f"CREATE OR REPLACE VIEW {full} AS {text}"))
        manifest = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], MANIFEST_SCHEMA).coalesce(1)
        done = _register(spark, self, [(k, *r) for k, r in enumerate(rows)])
        self.store.write(manifest, *MANIFEST, fmt="json")
        return done

    def attach(self, spark: SparkSession) -> dict[str, list[str]]:
        """Register what the lake's manifest lists, under the names it was published with."""
        rows = (spark.read.schema(MANIFEST_SCHEMA).json(self.store.path(*MANIFEST)).orderBy("seq").collect())
        return _register(spark, self, [tuple(r) for r in rows])      # one row per table and view

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(f"{self.gold_schema}.{name}")

    def view(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(f"{self.analytics_schema}.{name}")

    def counts(self, spark: SparkSession, tables) -> dict[str, int]:
        """Rows of each published table, from file footers alone, in one job."""
        parts = [self.table(spark, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("t"), "n") for n in tables]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return {r["t"]: r["n"] for r in out.collect()}


def _tables_of(sql: str) -> list[str]:
    import re
    return re.findall(r"\{gold\}\.(\w+)", sql)


def _known(spark: SparkSession, name: str) -> tuple[str | None, str | None]:
    """(location, fingerprint of the registration) of a table, or (None, None)."""
    if not spark.catalog.tableExists(name):
        return None, None
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return rows.get("Location"), props.get("stratum.columns")


def _register(spark: SparkSession, warehouse: Warehouse, rows: list[tuple]) -> dict[str, list[str]]:
    done: dict[str, list[str]] = {"table": [], "view": []}
    # refuse before anything changes: another lake's table of the same name stays what it is
    known = {name: _known(spark, name) for _, kind, name, *_ in rows if kind == "table"}
    for _, kind, name, location, *_ in rows:
        if kind == "table" and known[name][0] is not None and not _same_path(known[name][0], location):
            raise ValueError(f"{name} is registered at {known[name][0]}, another lake; publish under other schemas")
    for schema in (warehouse.gold_schema, warehouse.analytics_schema):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for _, kind, name, location, columns, ddl in rows:
        if kind == "table" and known[name] == (known[name][0], columns) and known[name][0] is not None:
            spark.sql(f"REFRESH TABLE {name}")
        elif kind == "table":
            spark.sql(f"DROP TABLE IF EXISTS {name}")        # external: the files stay
            spark.sql(ddl)
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('stratum.columns' = {_text(columns)})")
        else:
            spark.sql(ddl)
        if kind == "table" and "PARTITIONED BY" in columns:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        done[kind].append(name.replace("`", ""))
    return done
