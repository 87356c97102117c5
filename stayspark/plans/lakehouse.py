"""Bronze, silver and gold: declared JSON lines to typed history and summaries, exactly once.

Bronze reads all pending files in one scan, quarantines malformed lines, compares counts with the manifest and admits either
all files or none. Silver validates the batch's bronze rows, quarantines what fails, and types the rest. Gold makes
the four summaries anew for the check-in dates whose history has changed since. Every layer leaves an audit row, whether it ends well or not; a run that has been loaded is skipped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from stayspark.functions.text import digest
from stayspark.operators import aggregates, rules
from stayspark.plans.store import TableStore
from stayspark.sources.contract import Contract, load_contract
from stayspark.sources.manifest import declared_counts, read_manifest, safe_manifest_path

PROVENANCE = "batch_id string, airflow_dag_id string, airflow_run_id string, airflow_try_number long"
MESSAGE = 4000
DATE = "check_in_date"
LITERALS = 200
LEDGER = "batch_id string, file_path string, manifest_path string, target_table string, status string, started_at timestamp, loaded_at timestamp, row_count long, error_message string"
AUDIT = "batch_id string, airflow_dag_id string, airflow_run_id string, airflow_try_number long, layer string, contract_version string, status string, input_records long, output_records long, quarantined_records long, error_message string, completed_at timestamp"
QUARANTINE = f"record_id string, {PROVENANCE}, source_file_path string, manifest_path string, raw_record_json string, failed_rules array<string>, failure_reason string, quarantine_layer string, quarantined_at timestamp"
HISTORY = (
    "record_id string, hotel_name string, hotel_url string, price_amount decimal(18,0), rating decimal(3,1), review_count long, star_rating decimal(2,1), crawled_at timestamp, destination string, "
    f"normalized_destination string, check_in_date date, {PROVENANCE}, source_file_path string, manifest_path string, bronze_ingested_at timestamp, transformed_at timestamp"
)
SUMMARIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "gold_entity_daily": aggregates.entity_daily,
    "gold_destination_daily": aggregates.destination_daily,
    "gold_rating_distribution": aggregates.rating_distribution,
    "gold_price_by_star": aggregates.price_by_star,
}


def now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class Lakehouse:
    store: TableStore
    contract: Contract
    clock: Callable[[], datetime] = now

    @classmethod
    def at(cls, spark: SparkSession, root: str, contract: Contract | None = None, clock: Callable[[], datetime] = now) -> Lakehouse:
        return cls(TableStore(spark, root), contract or load_contract(), clock)

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    # -- setup and migration

    def setup(self) -> list[str]:
        """Create what is missing; add optional fields that the contract has gained. A new required field is refused."""
        business = ", ".join(f"{c} string" for c in self.contract.columns)
        tables = {"bronze": f"record_id string, {business}, {PROVENANCE}, source_file_path string, manifest_path string, ingested_at timestamp, raw_record_json string", "ledger": LEDGER, "quarantine": QUARANTINE, "audit": AUDIT, "history": HISTORY}
        for name, schema in tables.items():
            self.store.create(name, schema)
        self.store.rename_column("history", "date", "check_in_date")
        have = self.store.schema("bronze").names
        new = [f for f in self.contract.fields if f.name not in have]
        if required := [f.name for f in new if f.required]:
            raise ValueError(f"new required fields need a migration of their own: {required}")
        self.store.add_columns("bronze", [StructField(f.name, StringType()) for f in new])
        for name, summary in SUMMARIES.items():
            if not self.store.exists(name):
                self.refresh(name, summary)
        return [*tables, *SUMMARIES]

    # -- bookkeeping

    def _audit(self, manifest: dict[str, Any], layer: str, status: str, rows: tuple[int, int, int], error: str | None = None) -> None:
        row = (manifest["batch_id"], manifest["airflow_dag_id"], manifest["airflow_run_id"], manifest["airflow_try_number"], layer, self.contract.version, status, *rows, error[:MESSAGE] if error else None, self.clock())
        self.store.upsert("audit", self.spark.createDataFrame([row], AUDIT), ["batch_id", "layer"])

    def _ledger(self, manifest: dict[str, Any], path: str, files: dict[str, int | None], status: str, error: str | None = None) -> None:
        at = self.clock()
        rows = [(manifest["batch_id"], f, path, "bronze", status, at, at if status == "loaded" else None, n, error[:MESSAGE] if error else None) for f, n in files.items()]
        if not rows:
            return

        def first_start(new: DataFrame, old: DataFrame) -> DataFrame:
            known = old.select("batch_id", "file_path", F.col("started_at").alias("_first"))
            return new.join(known, ["batch_id", "file_path"], "left").withColumn("started_at", F.coalesce("_first", "started_at"))

        self.store.upsert("ledger", self.spark.createDataFrame(rows, LEDGER), ["batch_id", "file_path"], keep=first_start)

    def _quarantine(self, df: DataFrame, layer: str, batch: str) -> int:
        """Quarantined rows of a batch, merged by record id; no other batch's rows are touched."""
        rows = df.withColumns({"quarantine_layer": F.lit(layer), "quarantined_at": F.lit(self.clock())}).dropDuplicates(["record_id"])
        n = rows.count()
        if n:
            self.store.upsert("quarantine", rows, ["record_id"], scope={"batch_id": batch})
        return n

    # -- layers

    def lines(self, files: list[str], manifest: dict[str, Any], path: str) -> DataFrame:
        """Parsed lines of all files, with provenance and record id."""
        # Full URIs come back from _metadata; declared paths are matched by their ends.
        raw = self.spark.read.text(files).select(F.col("value").alias("raw_record_json"), F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^file:/+", "/").alias("source_file_path"))
        known = {k: F.lit(manifest[k]) for k in ("batch_id", "airflow_dag_id", "airflow_run_id")}
        return rules.parsed_lines(raw, self.contract).withColumns({**known, "airflow_try_number": F.lit(manifest["airflow_try_number"]).cast("long"), "manifest_path": F.lit(path), "ingested_at": F.lit(self.clock()), "record_id": digest(F.lit(manifest["batch_id"]), "source_file_path", "raw_record_json")})

    def pending(self, plan: DataFrame, batch: str) -> DataFrame:
        """Declared files (file_path, declared) that the ledger has not as loaded for this batch."""
        loaded = self.store.read("ledger").where((F.col("batch_id") == batch) & (F.col("status") == "loaded")).select("file_path")
        return plan.join(loaded, "file_path", "left_anti")

    def bronze(self, path: str, root: str = "/") -> dict[str, int]:
        manifest = read_manifest(self.spark, str(safe_manifest_path(path, root)))
        declared = declared_counts(manifest, path)
        self.store.require("bronze", "ledger", "quarantine", "audit")
        pending: dict[str, int] = {}
        try:
            plan = self.spark.createDataFrame(list(declared.items()), "file_path string, declared long")
            pending = {r[0]: r[1] for r in self.pending(plan, manifest["batch_id"]).collect()}
            skipped = len(declared) - len(pending)
            if not pending:
                return {"input_records": 0, "output_records": 0, "quarantined_records": 0, "skipped_files": skipped}
            lines = self.lines(list(pending), manifest, path).persist()
            try:
                counts = lines.groupBy("source_file_path").agg(F.count("*").alias("found"), F.count_if(~F.col("is_object")).alias("bad")).collect()
                found = {r["source_file_path"]: r["found"] for r in counts}
                if wrong := {f: (n, found.get(f, 0)) for f, n in pending.items() if found.get(f, 0) != n}:
                    raise ValueError(f"declared and found records differ: {wrong}")
                bad = lines.where(~F.col("is_object")).withColumns({"failed_rules": F.array(F.lit("malformed_json")), "failure_reason": F.lit("malformed_json")})
                quarantined = self._quarantine(bad, "bronze", manifest["batch_id"])
                rows, invalid = sum(found.values()), sum(r["bad"] for r in counts)
                if rows == 0:
                    raise ValueError("no records")
                if rules.too_many_invalid(rows, invalid):
                    raise ValueError(f"too many malformed records: {invalid} of {rows}")
                self._ledger(manifest, path, dict.fromkeys(pending, None), "loading")
                good = lines.where("is_object")
                written = self.store.insert_only("bronze", good, ["record_id"], scope={"batch_id": manifest["batch_id"]})
                each = {r[0]: r[1] for r in good.groupBy("source_file_path").agg(F.countDistinct("record_id")).collect()}
                self._ledger(manifest, path, {f: each.get(f, 0) for f in pending}, "loaded")
            finally:
                lines.unpersist()
        except Exception as e:
            self._ledger(manifest, path, dict.fromkeys(pending, None), "failed", str(e))
            self._audit(manifest, "bronze", "failed", (0, 0, 0), str(e))
            raise
        self._audit(manifest, "bronze", "success", (rows, sum(each.values()), quarantined))
        return {"input_records": rows, "output_records": written, "quarantined_records": quarantined, "skipped_files": skipped}

    def batch(self, manifest: dict[str, Any], files: list[str]) -> DataFrame:
        """The batch's bronze rows: folders of other batches are not opened, and conditions reach the Parquet scan; more than
        LITERALS files are a semi-join."""
        own = self.store.read("bronze", {"batch_id": manifest["batch_id"]}).where(F.col("batch_id") == manifest["batch_id"])
        if len(files) <= LITERALS:
            return own.where(F.col("source_file_path").isin(files))
        declared = self.spark.createDataFrame([(f,) for f in set(files)], "source_file_path string")
        return own.join(declared, "source_file_path", "left_semi").select(*own.columns)

    def silver(self, path: str, root: str = "/") -> dict[str, int]:
        manifest = read_manifest(self.spark, str(safe_manifest_path(path, root)))
        files = list(declared_counts(manifest, path))
        self.store.require("bronze", "history", "quarantine", "audit")
        rows = bad = 0
        try:
            checked = rules.validated(self.batch(manifest, files), self.contract).persist()
            try:
                rows, bad = checked.agg(F.count("*"), F.count_if(F.size("failed_rules") > 0)).first()
                if rows == 0:
                    raise ValueError("no bronze records for this manifest")
                self._quarantine(rules.quarantine_reason(checked), "silver", manifest["batch_id"])
                if rules.too_many_invalid(rows, bad):
                    raise ValueError(f"too many invalid records: {bad} of {rows}")
                typed = rules.typed(rules.valid_rows(checked)).withColumns({"bronze_ingested_at": F.col("ingested_at"), "transformed_at": F.lit(self.clock())})
                written = self.store.insert_only("history", typed, ["record_id"], scope={"batch_id": manifest["batch_id"]}, by=DATE)
            finally:
                checked.unpersist()
        except Exception as e:
            self._audit(manifest, "silver", "failed", (rows, 0, bad), str(e))
            raise
        self._audit(manifest, "silver", "success", (rows, rows - bad, bad))
        return {"input_records": rows, "output_records": written, "quarantined_records": bad}

    def changed_dates(self, name: str) -> set[str] | None:
        """Check-in dates of history folders that a summary has not taken in yet; None if all must be made anew: it has not
        been made so before, folders that it took in are gone, or a new one is not of a single date."""
        history, seen = self.store.scopes("history"), self.store.seen(name) if self.store.exists(name) else None
        new = {f: scope.get(DATE) for f, scope in history.items() if f not in set(seen or [])}
        if seen is None or set(seen) - history.keys() or None in new.values():
            return None
        return set(new.values())

    def history_of(self, dates: set[str]) -> DataFrame:
        """The history of some dates; other dates' folders are not opened."""
        folders = [f for f, scope in self.store.scopes("history").items() if scope.get(DATE, next(iter(dates))) in dates]
        return self.store.of("history", folders).where(F.col(DATE).isin([date.fromisoformat(d) for d in dates]))

    def refresh(self, name: str, summary: Callable[[DataFrame], DataFrame]) -> None:
        """Bring a summary up to the history."""
        dates = self.changed_dates(name)
        if dates is None or dates:
            rows = self.store.read("history") if dates is None else self.history_of(dates)
            self.store.replace_parts(name, summary(rows), DATE, dates, seen=list(self.store.scopes("history")))

    def gold(self, path: str, root: str = "/") -> dict[str, int]:
        """Bring the summaries up to all history, once the manifest has been validated; an empty history is refused. What a
        summary has taken in is kept with it, so dates of a batch whose gold failed are made with the next one."""
        manifest = read_manifest(self.spark, str(safe_manifest_path(path, root)))
        declared_counts(manifest, path)
        self.store.require("history", "audit", *SUMMARIES)
        rows = 0
        try:
            rows = self.store.read("history").count()
            if rows == 0:
                raise ValueError("history is empty: silver comes first")
            for name, summary in SUMMARIES.items():
                self.refresh(name, summary)
            out = {name: self.store.read(name).count() for name in SUMMARIES}
        except Exception as e:
            self._audit(manifest, "gold", "failed", (rows, 0, 0), str(e))
            raise
        self._audit(manifest, "gold", "success", (rows, sum(out.values()), 0))
        return out

    def run(self, path: str, root: str = "/") -> dict[str, dict[str, int]]:
        """All three layers for one manifest."""
        self.setup()
        return {"bronze": self.bronze(path, root), "silver": self.silver(path, root), "gold": self.gold(path, root)}
