"""Job parameters, write target and run context. No Spark needed here."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone


@dataclass(frozen=True)
class Target:
    """Where bronze tables live: ``[catalog.]schema``, with an optional folder.

    ``catalog_partitions``: the catalog keeps the folder of every partition. If it
    does not, partitions are found by listing folders, and a partitioned table can
    be overwritten by one call of the catalog.
    """

    schema: str = "bronze"
    catalog: str | None = None
    location: str | None = None
    table_format: str = "parquet"
    catalog_partitions: bool = True

    @property
    def namespace(self) -> str:
        parts = [self.catalog, self.schema] if self.catalog else [self.schema]
        return ".".join(f"`{p}`" for p in parts)

    def name(self, table: str) -> str:
        return f"{self.namespace}.`{table}`"

    def name_in_catalog(self, table: str) -> str:
        """Name without the catalog, which a rename does not take."""
        return f"`{self.schema}`.`{table}`"


@dataclass(frozen=True)
class RunContext:
    """One clock per run: it drives the extract timestamp and every batch id."""

    ts: datetime
    source_system: str = "sales_source"

    @classmethod
    def now(cls, source_system: str = "sales_source") -> RunContext:
        return cls(datetime.now(timezone.utc), source_system)

    def batch_id(self, prefix: str) -> str:
        return f"{prefix}_{self.ts:%Y%m%d_%H%M%S}"


@dataclass(frozen=True)
class PipelineConfig:
    """The parameters a job passes in, with their defaults."""

    catalog_name: str = "spark_catalog"
    schema_name: str = "bronze"
    sql_server_host: str = ""
    sql_database_name: str = ""
    sql_username: str = ""
    sql_password: str = field(default="", repr=False)
    source_system: str = "sales_source"
    table_format: str = "parquet"
    location: str | None = None
    staged_writes: bool = True
    catalog_partitions: bool = True  # see Target; without them readers never miss a table
    file_mb: int = 256  # of shuffled data per written file, about
    sample_size: int = 5  # rows of the customers sample in the report
    jdbc_partitions: int = 0  # 0: by the number of rows, see jdbc_rows_per_partition
    jdbc_rows_per_partition: int = 1_000_000
    jdbc_even_rows: bool = False  # split by quantiles of the key, for uneven keys
    jdbc_fetch_size: int = 10_000
    jdbc_encrypt: bool = True
    jdbc_options: Mapping[str, str] = field(default_factory=dict, repr=False)

    @classmethod
    def from_mapping(cls, params: Mapping[str, str]) -> PipelineConfig:
        unknown = set(params) - set(cls.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown parameters: {sorted(unknown)}")
        return cls(**{k: cls._typed(k, v) for k, v in params.items()})

    @classmethod
    def _typed(cls, name: str, value: object) -> object:
        """A job passes text; the default tells the type."""
        default = cls.__dataclass_fields__[name].default
        if not isinstance(value, str) or isinstance(default, str):
            return value
        if isinstance(default, bool):
            if value.lower() not in ("true", "false"):
                raise ValueError(f"{name}: true or false, not {value}")
            return value.lower() == "true"
        return int(value) if isinstance(default, int) else value

    @property
    def target(self) -> Target:
        return Target(
            self.schema_name,
            self.catalog_name,
            self.location,
            self.table_format,
            self.catalog_partitions,
        )
