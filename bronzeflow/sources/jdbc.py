"""Relational source over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from bronzeflow.config import PipelineConfig
from bronzeflow.specs import TableSpec


@dataclass(frozen=True)
class Partitioning:
    """Split of one read into ``partitions`` ranges of a numeric column."""

    column: str
    lower: int
    upper: int
    partitions: int


@dataclass(frozen=True)
class Boundaries:
    """Split of one read at values of a numeric column, in ascending order."""

    column: str
    at: tuple[int, ...]

    @property
    def predicates(self) -> list[str]:
        """One per part. Together they hold every row once, also one without a value."""
        edges = [f"{self.column} >= {b}" for b in self.at]
        ends = [f"{self.column} < {b}" for b in self.at]
        inner = [f"{low} AND {high}" for low, high in zip(edges, ends[1:])]
        return [f"{ends[0]} OR {self.column} IS NULL", *inner, edges[-1]]


@dataclass(frozen=True)
class JdbcSource:
    host: str = ""
    database: str = ""
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
    port: int = 1433
    encrypt: bool = True
    trust_server_certificate: bool = True
    url: str | None = None  # set it to reach a database of another kind
    partitions: int = 0  # 0: as many as the rows need
    rows_per_partition: int = 1_000_000
    even_rows: bool = False  # parts of equally many rows, not of equal ranges of the key
    fetch_size: int = 10_000
    options: dict[str, str] = field(default_factory=dict, repr=False)

    @classmethod
    def from_config(cls, cfg: PipelineConfig, **kwargs) -> JdbcSource:
        tuning = {
            "partitions": cfg.jdbc_partitions,
            "rows_per_partition": cfg.jdbc_rows_per_partition,
            "even_rows": cfg.jdbc_even_rows,
            "fetch_size": cfg.jdbc_fetch_size,
            "encrypt": cfg.jdbc_encrypt,
            "options": dict(cfg.jdbc_options),
        }
        return cls(
            cfg.sql_server_host,
            cfg.sql_database_name,
            cfg.sql_username,
            cfg.sql_password,
            **(tuning | kwargs),
        )

    @property
    def jdbc_url(self) -> str:
        if self.url:
            return self.url
        return (
            f"jdbc:sqlserver://{self.host}:{self.port};database={self.database}"
            f";encrypt={str(self.encrypt).lower()}"
            f";trustServerCertificate={str(self.trust_server_certificate).lower()}"
        )

    @property
    def connection_options(self) -> dict[str, str]:
        opts = {"driver": self.driver, "fetchsize": str(self.fetch_size)}
        if self.user:
            opts |= {"user": self.user, "password": self.password}
        return opts | self.options

    def read(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        """Snapshot of one bronze table, split over its numeric primary key.

        The parts are transactions of their own, so rows that change while they
        run may be seen before or after the change.
        """
        return self.read_since(spark, spec, None)

    def read_since(
        self, spark: SparkSession, spec: TableSpec, mark: datetime | None
    ) -> DataFrame:
        """Rows edited at the mark or later, or without a time; all without a mark.

        The mark is part of the database's query, and the split goes by the keys
        of the rows that are left: edited rows often lie at the top of the range.
        """
        where = ""
        if mark is not None:
            where = (
                f" WHERE {spec.edited_column} >= '{mark:%Y-%m-%dT%H:%M:%S.%f}'"
                f" OR {spec.edited_column} IS NULL"
            )
        present = self.present_columns(spark, spec) if spec.optional else spec.columns
        query = f"SELECT {', '.join(present)} FROM {spec.source_table}{where}"
        split = key_partitioning(spark, self, spec, where)
        return read_jdbc_table(spark, self, query, split, alias=spec.name)

    def present_columns(self, spark: SparkSession, spec: TableSpec) -> list[str]:
        """Columns of the contract, without optional ones that the source lacks."""
        none = read_jdbc_query(spark, self, f"SELECT * FROM {spec.source_table} WHERE 1 = 0")
        have = {c.lower() for c in none.columns}
        return [c for c in spec.columns if c not in spec.optional or c.lower() in have]


def read_jdbc_query(spark: SparkSession, source: JdbcSource, query: str) -> DataFrame:
    """Result of a SQL query, over one connection (``query`` rules out splitting)."""
    return (
        spark.read.format("jdbc")
        .option("url", source.jdbc_url)
        .option("query", query)
        .options(**source.connection_options)
        .load()
    )


def read_jdbc_table(
    spark: SparkSession,
    source: JdbcSource,
    table_or_subquery: str,
    partition: Partitioning | Boundaries | None = None,
    alias: str = "source_rows",
) -> DataFrame:
    """A table or subquery, read over several connections if a split is given."""
    relation = table_or_subquery
    if table_or_subquery.lstrip().upper().startswith("SELECT"):
        relation = f"({table_or_subquery}) {alias}"
    if partition is None:
        return spark.read.jdbc(source.jdbc_url, relation, properties=source.connection_options)
    if isinstance(partition, Boundaries):
        return spark.read.jdbc(
            source.jdbc_url,
            relation,
            predicates=partition.predicates,
            properties=source.connection_options,
        )
    return spark.read.jdbc(
        source.jdbc_url,
        relation,
        column=partition.column,
        lowerBound=partition.lower,
        upperBound=partition.upper,
        numPartitions=partition.partitions,
        properties=source.connection_options,
    )


def key_partitioning(
    spark: SparkSession, source: JdbcSource, spec: TableSpec, where: str = ""
) -> Partitioning | Boundaries | None:
    """Ranges over the primary key, from one query that the database answers.

    With ``even_rows`` a second one asks it for the quantiles of the key, for keys
    that are dense in some ranges and thin in others.

    It counts the rows that ``where`` leaves, too: without a number of partitions
    there is one for each ``rows_per_partition`` of them. NULL keys and keys
    outside the bounds are still read: Spark leaves the first and the last range
    open. None for an empty table, a key that is no number, or a single range.
    """
    if source.partitions == 1 or len(spec.primary_key) != 1:
        return None
    (key,) = spec.primary_key
    if dict(spec.fields)[key] not in ("int", "bigint"):
        return None
    bounds = read_jdbc_query(
        spark,
        source,
        f"SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT(*) AS n FROM {spec.source_table}{where}",
    ).first()
    if bounds[0] is None or bounds[0] == bounds[1]:
        return None
    parts = source.partitions or -(-int(bounds[2]) // source.rows_per_partition)
    if parts <= 1:
        return None
    if source.even_rows:
        return quantiles(spark, source, spec, key, parts, where)
    return Partitioning(key, int(bounds[0]), int(bounds[1]), parts)


def quantiles(
    spark: SparkSession, source: JdbcSource, spec: TableSpec, key: str, parts: int, where: str
) -> Boundaries | None:
    """The first key of each of ``parts`` groups of equally many rows, but for the lowest."""
    grouped = (
        f"SELECT {key} AS k, NTILE({parts}) OVER (ORDER BY {key}) AS part"
        f" FROM {spec.source_table}{where}"
    )
    query = f"SELECT part, MIN(k) AS first FROM ({grouped}) grouped GROUP BY part"
    # As many rows as parts.
    found = sorted(int(r[1]) for r in read_jdbc_query(spark, source, query).collect() if r[1] is not None)
    inner = sorted(set(found) - {found[0]}) if found else []
    return Boundaries(key, tuple(inner)) if inner else None
