"""Resource views over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.columns import epoch_ms
from tagloom.operators.upsert import dedupe_latest

SEQUENCE_COLUMNS = {
    "quantity": "d",
    "extendedprice": "d",
    "discount": "d",
    "tax": "d",
    "returnflag": "s",
    "linestatus": "s",
}


class Views:
    """The given tables of one folder, seen as resources."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its files are opened once for their schema."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def spread(self, name: str) -> DataFrame:
        """A table for heavy work per row: one stored in fewer splits than there are cores is spread over them."""
        table, cores = self.table(name), self.spark.sparkContext.defaultParallelism
        return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table

    def events(self) -> DataFrame:
        """Events; ``ts`` stays for time filters that reach the scan."""
        ms = epoch_ms(F.col("ts"))
        k = F.get_json_object("props", "$.k")
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("ev:"), F.col("event_id")).alias("externalId"),
            F.col("event_type").alias("type"),
            F.concat(F.lit("u:"), F.col("user_id")).alias("source"),
            "value",
            ms.alias("startTime"),
            ms.alias("lastUpdatedTime"),
            F.create_map(F.lit("type"), F.col("event_type"), F.lit("k"), k).alias("metadata"),
            "ts",
        )

    def datapoints(self, stored: bool = False) -> DataFrame:
        """Data points; with ``stored`` their ``ts`` stays for time ranges that reach the scan."""
        return self.table("events").select(
            F.concat(F.lit("u:"), F.col("user_id")).alias("externalId"),
            epoch_ms(F.col("ts")).alias("timestamp"),
            F.col("value").alias("valueNum"),
            *(["ts"] if stored else []),
        )

    def series(self) -> DataFrame:
        users = self.table("events").select("user_id").distinct()
        return users.select(
            F.col("user_id").alias("id"),
            F.concat(F.lit("u:"), F.col("user_id")).alias("externalId"),
            F.concat(F.lit("series "), F.col("user_id")).alias("name"),
            F.lit(False).alias("isString"),
            F.lit("value").alias("unit"),
        )

    def assets(self) -> DataFrame:
        """region > nation > customer."""
        unset = F.lit(None).cast("string")

        def level(df, id_, ext, name, parent_id, parent, region, source=unset):
            return df.select(
                id_.cast("long").alias("id"),
                ext.alias("externalId"),
                F.col(name).alias("name"),
                unset.alias("description"),
                parent_id.cast("long").alias("parentId"),
                parent.alias("parentExternalId"),
                (region + 1).cast("long").alias("rootId"),
                F.concat(F.lit("region:"), region).alias("rootExternalId"),
                F.create_map(F.lit("level"), F.lit(ext_level(name))).alias("metadata"),
                source.alias("source"),
                (region + 1).cast("long").alias("dataSetId"),
            )

        def ext_level(name):
            return {"r_name": "region", "n_name": "nation", "c_name": "customer"}[name]

        c = F.col
        prefix = lambda p, column: F.concat(F.lit(p), c(column))
        nation = self.table("nation")
        regions = level(
            self.table("region"), c("r_regionkey") + 1, prefix("region:", "r_regionkey"), "r_name",
            F.lit(None), unset, c("r_regionkey"),
        )
        nations = level(
            nation, c("n_nationkey") + 100, prefix("nation:", "n_nationkey"), "n_name",
            c("n_regionkey") + 1, prefix("region:", "n_regionkey"), c("n_regionkey"),
        )
        customers = level(
            self.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")),
            c("c_custkey") + 1000, prefix("customer:", "c_custkey"), "c_name",
            c("c_nationkey") + 100, prefix("nation:", "c_nationkey"), c("n_regionkey"), c("c_mktsegment"),
        )
        return regions.unionByName(nations).unionByName(customers)

    def assets_incoming(self) -> DataFrame:
        """The next load of the tree: overdrawn customers gone, BUILDING ones described, a twin for rich ones."""
        accounts = self.table("customer").select(
            F.concat(F.lit("customer:"), F.col("c_custkey")).alias("externalId"), "c_custkey", "c_acctbal", "c_mktsegment"
        )
        tree = self.assets().join(accounts, "externalId", "left")
        kept = tree.where(F.col("c_acctbal").isNull() | (F.col("c_acctbal") >= 0)).withColumn(
            "description", F.when(F.col("c_mktsegment") == "BUILDING", F.lit("changed"))
        )
        twins = (
            tree.where(F.col("c_acctbal") > 9000)
            .withColumn("id", F.col("c_custkey") + 900_000_000)
            .withColumn("externalId", F.concat(F.lit("new:"), F.col("c_custkey")))
        )
        columns = self.assets().columns
        return kept.select(*columns).unionByName(twins.select(*columns))

    def raw(self) -> DataFrame:
        return self.table("orders").select(
            F.lit("sales").alias("dbName"),
            F.col("o_orderstatus").alias("tableName"),
            F.concat(F.lit("o:"), F.col("o_orderkey")).alias("key"),
            F.to_json(
                F.struct(
                    F.col("o_custkey").alias("custkey"),
                    F.col("o_totalprice").alias("totalprice"),
                    F.col("o_orderpriority").alias("priority"),
                )
            ).alias("columns"),
            epoch_ms(F.col("o_orderdate")).alias("lastUpdatedTime"),
        )

    def sequence_rows(self) -> DataFrame:
        """Order lines as sequence rows: the latest line per (order, line number)."""
        lines = dedupe_latest(
            self.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
        )
        return lines.select(
            F.concat(F.lit("s:"), F.col("l_orderkey")).alias("externalId"),
            F.col("l_linenumber").cast("long").alias("rowNumber"),
            *[F.col(f"l_{n}").alias(n) for n in SEQUENCE_COLUMNS],
        )

    def files(self) -> DataFrame:
        return self.table("pages").select(
            F.col("page_id").alias("id"),
            F.concat(F.lit("f:"), F.col("page_id")).alias("externalId"),
            F.col("url").alias("name"),
            F.lit("text/html").alias("mimeType"),
        )

    def file_binaries(self) -> DataFrame:
        """Page bodies; pages whose address has a ``ref`` parameter are headers only."""
        return (
            self.table("pages")
            .where(~F.col("url").contains("ref="))
            .select(
                F.col("page_id").alias("id"),
                F.concat(F.lit("f:"), F.col("page_id")).alias("externalId"),
                F.encode("html", "UTF-8").alias("binary"),
            )
        )

    def relationships(self) -> DataFrame:
        return self.table("orders").select(
            F.concat(F.lit("r:"), F.col("o_orderkey")).alias("externalId"),
            F.concat(F.lit("customer:"), F.col("o_custkey")).alias("sourceExternalId"),
            F.lit("ASSET").alias("sourceType"),
            F.concat(F.lit("o:"), F.col("o_orderkey")).alias("targetExternalId"),
            F.lit("RAW").alias("targetType"),
            F.lit(1.0).cast("float").alias("confidence"),
            epoch_ms(F.col("o_orderdate")).alias("lastUpdatedTime"),
        )

    def labels(self) -> DataFrame:
        types = self.table("part").select("p_type").distinct()
        return types.select(
            F.concat(F.lit("type:"), F.col("p_type")).alias("externalId"), F.col("p_type").alias("name")
        )

    def data_sets(self) -> DataFrame:
        return self.table("region").select(
            (F.col("r_regionkey") + 1).cast("long").alias("id"),
            F.concat(F.lit("ds:"), F.col("r_regionkey")).alias("externalId"),
            F.create_map(F.lit("region"), F.col("r_name")).alias("metadata"),
        )

    def event_items(self) -> DataFrame:
        """Listed items: by externalId, some again by id, and some that no event has."""
        marked = self.table("labels")
        unset = lambda kind: F.lit(None).cast(kind)
        by_name = marked.select(
            unset("long").alias("id"), F.concat(F.lit("ev:"), F.col("doc_id")).alias("externalId")
        )
        by_id = marked.where("quality = 1").select(F.col("doc_id").alias("id"), unset("string").alias("externalId"))
        unknown = self.table("supplier").select(
            unset("long").alias("id"), F.concat(F.lit("supplier:"), F.col("s_suppkey")).alias("externalId")
        )
        return by_name.unionByName(by_id).unionByName(by_id).unionByName(unknown)
