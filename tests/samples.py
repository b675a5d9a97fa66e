"""Small sources whose rows and columns a test can change between runs."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from tidegate.functions import quoted
from tidegate.plans.run import run_pipeline
from tidegate.sources import Frames, Sources
from tidegate.state import tables
from tidegate.state.snapshots import Layout, Snapshots
from tidegate.state.store import StateStore
from tidegate.state.vocabulary import LoadError

AGP, CSD, STG = "Asset_Generation_PI_Data_T", "CSD_Assets_T", "Asset_Gen_PI_Data_T_STG"
AGP_ID, CSD_ID = 1, 2

# --- fixed values: the sample tables and their configuration ------------------------
AGP_SCHEMA = {
    "AssetGenerationId": "int",
    "AssetCode": "string",
    "GenerationMWh": "decimal(18,3)",
    "ReadingDate": "date",
    "LastModifiedUtc": "timestamp_ntz",
}
AGP_ROWS = [
    (1, "SOLAR-01", Decimal("125.500"), date(2026, 9, 13), datetime(2026, 9, 13, 10)),
    (2, "WIND-01", Decimal("342.125"), date(2026, 9, 14), datetime(2026, 9, 14, 10)),
    (3, "HYDRO-01", Decimal("510.750"), date(2026, 9, 15), datetime(2026, 9, 15, 10)),
]
CSD_SCHEMA = {
    "AssetId": "int",
    "AssetName": "string",
    "AssetType": "string",
    "IsActive": "boolean",
    "LastModifiedUtc": "timestamp_ntz",
}
CSD_ROWS = [
    (101, "Solar Farm North", "Solar", True, datetime(2026, 9, 13, 8)),
    (102, "Wind Park East", "Wind", True, datetime(2026, 9, 14, 8)),
    (103, "Hydro Station West", "Hydro", True, datetime(2026, 9, 15, 8)),
]
CONFIGS = [
    {
        "SourceTable": AGP,
        "TargetTable": AGP,
        "Load": "Yes",
        "LoadType": "WATERMARK",
        "WatermarkColumn": "LastModifiedUtc",
        "PrimaryKeyColumn": "AssetGenerationId",
    },
    {
        "SourceTable": CSD,
        "TargetTable": CSD,
        "Load": "Yes",
        "LoadType": "FULL",
        "PrimaryKeyColumn": "AssetId",
    },
    {
        "SourceTable": STG,
        "TargetTable": STG,
        "Load": "No",
        "LoadType": "FULL",
        "PrimaryKeyColumn": "StageId",
    },
]


class Table:
    """A source table in memory: column name to type, and rows as dicts."""

    def __init__(self, schema: dict[str, str], rows: list[tuple]):
        self.schema = dict(schema)
        self.rows = [dict(zip(schema, r)) for r in rows]

    def frame(self, spark):
        ddl = ", ".join(f"{quoted(n)} {t}" for n, t in self.schema.items())
        return spark.createDataFrame([tuple(r.get(n) for n in self.schema) for r in self.rows], ddl)

    def add_column(self, name, kind, value=lambda row: None):
        self.schema[name] = kind
        for row in self.rows:
            row[name] = value(row)

    def drop_column(self, name):
        del self.schema[name]

    def rename(self, old, new):
        self.schema = {new if n == old else n: t for n, t in self.schema.items()}
        for row in self.rows:
            row[new] = row.pop(old)


class World:
    """A state folder, its sources, and a clock that moves one second per reading."""

    def __init__(self, spark, root, configs=CONFIGS, layout=Layout()):
        self.spark, self.now = spark, datetime(2026, 9, 16)
        self.tables = {AGP: Table(AGP_SCHEMA, AGP_ROWS), CSD: Table(CSD_SCHEMA, CSD_ROWS)}
        self.store = StateStore(spark, str(root), self.tick)
        self.snapshots = Snapshots(self.store, layout)
        self.store.add_configs(configs)
        self.slept = []

    def tick(self):
        self.now += timedelta(seconds=1)
        return self.now

    @property
    def sources(self):
        frames = {
            ("src", n): (lambda t=t: t.frame(self.spark)) for n, t in self.tables.items()
        }
        return Sources(self.spark, {}, Frames(frames))

    def run(self, run_id, **kwargs):
        """The run's error code, or None when it succeeded."""
        try:
            run_pipeline(
                self.store, self.snapshots, self.sources, run_id, sleep=self.slept.append, **kwargs
            )
        except LoadError as error:
            return error.code
        return None

    def log(self, log, run_id=None):
        df = self.store.current(log) if log.key else self.store.read(log)
        if run_id is not None:
            df = df.filter(df.AdfPipelineRunId == run_id)
        return [r.asDict() for r in df.orderBy(log.key or "ConfigId").collect()]

    def attempts(self, run_id, config_id=None):
        rows = self.log(tables.ATTEMPT, run_id)
        return [r for r in rows if config_id in (None, r["ConfigId"])]

    def checks(self, attempt):
        rows = self.log(tables.CHECK)
        return [r for r in rows if r["TableLoadAuditId"] == attempt["TableLoadAuditId"]]

    def events(self, run_id, config_id):
        rows = self.log(tables.NOTIFICATION, run_id)
        return [r["EventType"] for r in rows if r["ConfigId"] == config_id]

    def requests(self, config_id):
        return [r for r in self.log(tables.REQUEST) if r["ConfigId"] == config_id]

    def run_row(self, run_id):
        return self.log(tables.RUN, run_id)[0]

    def curated(self, config_id):
        return self.snapshots.table(config_id)

    def rows(self, config_id, *columns):
        return sorted(tuple(r) for r in self.curated(config_id).select(*columns).collect())
