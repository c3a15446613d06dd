"""End-to-end jobs: land -> datalake (upsert) -> dwh (refresh) -> reports.

Each step reads published tables and stages new versions, so lineage never
spans more than one step and a lost executor only recomputes work of the
running step.  Quality checks run on every keyed table a step staged, before
it is published.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tenderlake import schemas
from tenderlake.operators import codes, companies, contracts, quality, reports, statements
from tenderlake.session import drop_scratch, materialize, scratch_path
from tenderlake.sinks.warehouse import COMPRESSION, Staged, UpsertResult, Warehouse
from tenderlake.sources import (award_rows, clean_loaded, contract_rows, defective_values, landed_contracts,
                                read_delimited, rejected_documents, strip_escapes, typed_contracts, value_defects)

# Declared widths of the registry landing table (every column 256 bytes).
REGISTRY_WIDTHS = {c: 256 for c in schemas.REGISTRY_COLUMNS}


@dataclass
class StepReport:
    step: str
    load_id: str = ""
    upserts: dict[str, UpsertResult] = field(default_factory=dict)
    checks: list[dict] = field(default_factory=list)
    notes: dict[str, int] = field(default_factory=dict)


class Pipeline:
    """A step stages its tables, checks the staged rows and only then
    publishes them: a table that fails its check never becomes current.

    Rows without a key go to ``rejects.<table>`` before anything else looks at
    them, and their number to the step's report.  Reject tables keep the rows
    of every load under its ``load_id``; a load that is repeated under the same
    id replaces its own rows.  ``keep_versions``: after a step is published,
    delete all but that many newest versions of every table it wrote (default:
    keep all).  With ``strict=False`` the checks run all the same, but a failed
    one is left to the step's report (``passed``) and the table is published:
    for sources that list several rows under one key."""

    def __init__(self, spark: SparkSession, warehouse: Warehouse, check: bool = True,
                 keep_versions: int | None = None, strict: bool = True):
        self.spark = spark
        self.wh = warehouse
        self.check = check
        self.keep_versions = keep_versions
        self.strict = strict
        self._staged: list[tuple[Staged, str | None]] = []
        self._scratch: list[str] = []

    def _begin(self, name: str, load_id: str | None = None) -> StepReport:
        """Forget what a step that failed half-way had staged: it is never published."""
        self._staged, self._scratch = [], []
        return StepReport(name, load_id or f"{name}-{uuid.uuid4().hex[:12]}")

    def _overwrite(self, df: DataFrame, layer: str, table: str, schema: StructType, key: str | None = None) -> None:
        """Stage a whole table; with ``key`` it is checked before it is published."""
        self._staged.append((self.wh.stage(schemas.conform(df, schema), layer, table), key))

    def _upsert(self, step: StepReport, df: DataFrame, layer: str, table: str, key: str, schema: StructType,
                distinct: bool = True, rejected: int = 0, merge: Callable[[DataFrame], DataFrame] | None = None) -> None:
        staged = self.wh.stage_upsert(schemas.conform(df, schema), layer, table, key, distinct=distinct, merge=merge)
        staged.result.null_keys_rejected += rejected
        step.upserts[table] = staged.result
        self._staged.append((staged, key))

    def _pending(self, step: StepReport, df: DataFrame, table: str, key: str, schema: StructType,
                 merge: Callable[..., DataFrame], key_sql: str | None = None, rejected: int = 0) -> None:
        staged = self.wh.stage_pending(schemas.conform(df, schema), "datalake", table, key, merge, key_sql)
        staged.result.null_keys_rejected += rejected
        step.upserts[table] = staged.result
        self._staged.append((staged, key))

    def _reject(self, step: StepReport, rows: DataFrame, table: str) -> None:
        """Keep rows that a load leaves out, under the load's id: a repeated load replaces its own and adds none."""
        self.wh.upsert(rows.withColumn("load_id", F.lit(step.load_id)), "rejects", table, "load_id", distinct=False)

    def _land(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` evaluated once, into the scratch folder that the step drops at its end."""
        path = scratch_path(self.spark, f"landed-{name}")
        self._scratch.append(path)
        return materialize(df, f"landed-{name}", path, COMPRESSION)

    def _keyed(self, step: StepReport, df: DataFrame, table: str, key: str) -> tuple[DataFrame, int]:
        """(rows that have a key, number of those that don't); the latter are kept in ``rejects.<table>``."""
        without = df.where(F.col(key).isNull())
        rejected = without.count()
        if rejected:
            self._reject(step, without, table)
        step.notes[f"{table}_without_key"] = rejected
        return df.where(F.col(key).isNotNull()), rejected

    def _commit(self, step: StepReport) -> StepReport:
        staged, self._staged = self._staged, []
        scratch, self._scratch = self._scratch, []
        for path in scratch:
            drop_scratch(self.spark, path)
        frames = {f"{s.layer}.{s.table}": (self.wh.preview(s), key) for s, key in staged if key}
        if self.check and frames:
            report = quality.quality_report(frames)
            step.checks = (quality.assert_quality(report) if self.strict  # a row per table either way
                           else [r.asDict() for r in report.collect()])
        for s, _ in staged:  # all or none, as far as other writers are known by now
            self.wh.rebased(s)
        for s, _ in staged:
            self.wh.publish(s)
        if self.keep_versions:
            for s, _ in staged:
                self.wh.vacuum(s.layer, s.table, keep=self.keep_versions)
        return step

    # -- Entry A: contracts ------------------------------------------------------
    def load_contracts(self, path: str, multi_line: bool = False, widths: dict[str, int] | None = None,
                       tolerant: bool = False) -> StepReport:
        """Parse the documents once into a columnar staging table, then derive
        contract and award rows from it (each reads only its columns).

        A malformed document stops the load; with ``tolerant`` such documents
        are kept in ``rejects.decp_documents`` and counted."""
        step = self._begin("load_contracts")
        if tolerant:
            documents = self._land(rejected_documents(self.spark, path, multi_line), "documents")
            step.notes["documents_rejected"] = documents.count()
            if step.notes["documents_rejected"]:
                self._reject(step, documents, "decp_documents")
        self.wh.overwrite(landed_contracts(self.spark, path, multi_line, tolerant), "staging", "decp_contracts")
        return self._merge_contracts(step, self.wh.read("staging", "decp_contracts"), widths)

    def load_contract_rows(self, landed: DataFrame, load_id: str, widths: dict[str, int] | None = None) -> StepReport:
        """The same load for contracts that are landed already, e.g. a stream's micro-batch.

        ``load_id`` names the batch: replayed under the same id it changes nothing.  Its rows are written once and
        merged by readers of the tables, or for good by :meth:`settle_contracts`."""
        step = self._begin("load_contract_rows", load_id)
        return self._merge_contracts(step, self._land(landed, "contracts"), widths, pending=True)

    def settle_contracts(self) -> None:
        """Merge what batches of landed contracts left to the readers of both tables."""
        for table in ("decp_marches", "decp_titulaires"):
            self.wh.settle("datalake", table)

    def _merge_contracts(self, step: StepReport, landed: DataFrame, widths: dict[str, int] | None,
                         pending: bool = False) -> StepReport:
        """Of the rows known so far and the landed ones the newest publication of each contract stays, and of each
        award the row with the longest name: any order and mix of loads gives the same tables.

        Values that don't fit their type are counted, and kept in ``rejects.decp_values``."""
        seen = landed.agg(F.count(F.lit(1)).alias("contracts_landed"), *value_defects()).first().asDict()
        landed_rows = seen.pop("contracts_landed")
        defects = {k: int(v or 0) for k, v in seen.items()}
        step.notes.update(defects)
        if any(defects.values()):
            self._reject(step, defective_values(landed), "decp_values")
        nested = typed_contracts(landed)
        marches, rejected = self._keyed(step, contracts.marches_typed(
            clean_loaded(strip_escapes(contract_rows(nested)), widths)), "decp_marches", "decp_uid")
        awards = contracts.award_uid(clean_loaded(strip_escapes(award_rows(nested)), widths))
        if pending:
            self._pending(step, marches, "decp_marches", "decp_uid", schemas.STORED_MARCHES, contracts.newest_marches,
                          rejected=rejected)
            self._pending(step, awards, "decp_titulaires", "decp_bridge_uid", schemas.DATALAKE_TITULAIRES,
                          contracts.titulaires_unique, key_sql=contracts.AWARD_UID_SQL)
            return self._loaded(step, landed_rows)
        # both batches are one row per key: no whole-row distinct
        self._upsert(step, contracts.newest_marches(marches), "datalake", "decp_marches", "decp_uid",
                     schemas.STORED_MARCHES, distinct=False, rejected=rejected, merge=contracts.newest_marches)
        self._upsert(step, contracts.longest_named(awards), "datalake", "decp_titulaires", "decp_bridge_uid",
                     schemas.DATALAKE_TITULAIRES, distinct=False, merge=contracts.longest_named)
        return self._loaded(step, landed_rows)

    def _loaded(self, step: StepReport, landed_rows: int) -> StepReport:
        """Publish a load of contracts and keep its counts."""
        done = self._commit(step)
        counts = {**step.notes, "contracts_landed": landed_rows}
        row = self.spark.createDataFrame([(step.load_id, step.step, k, v) for k, v in sorted(counts.items())],
                                         "load_id string, step string, metric string, value long")
        self.wh.upsert(row, "rejects", "loads", "load_id", distinct=False)
        return done

    # -- Entry B: contracts warehouse layer ----------------------------------------
    def refresh_contracts(self) -> StepReport:
        step = self._begin("refresh_contracts")
        wh = self.wh
        self._overwrite(contracts.dwh_titulaires(wh.read("datalake", "decp_titulaires")), "dwh", "decp_titulaires",
                        schemas.DWH_TITULAIRES, "decp_bridge_uid")
        titulaires = wh.preview(self._staged[-1][0])
        self._overwrite(contracts.marches_prepared(wh.read("datalake", "decp_marches")), "dwh", "decp_marches",
                        schemas.DWH_MARCHES, "decp_uid")
        marches = wh.preview(self._staged[-1][0])
        self._overwrite(contracts.siren_used(titulaires), "dwh", "decp_siren_used", schemas.SIREN_USED)
        self._overwrite(contracts.time_dimension(marches), "dwh", "time", schemas.TIME)
        return self._commit(step)

    # -- company registry ---------------------------------------------------------
    def load_registry(self, path: str, widths: dict[str, int] | None = None, multi_line: bool = False) -> StepReport:
        step = self._begin("load_registry")
        reg = clean_loaded(read_delimited(self.spark, path, schemas.REGISTRY, sep=",", header=True,
                                          multi_line=multi_line), REGISTRY_WIDTHS if widths is None else widths)
        keyed, rejected = self._keyed(step, self._land(reg, "siren_attributes"), "siren_attributes", "siren")
        self._upsert(step, keyed, "datalake", "siren_attributes", "siren", schemas.REGISTRY, rejected=rejected)
        return self._commit(step)

    def refresh_registry(self) -> StepReport:
        """Companies whose siren is not a number get a NULL VAT number instead
        of failing the refresh; their count is observed during the write."""
        step = self._begin("refresh_registry")
        std = companies.siren_standardized(self.wh.read("datalake", "siren_attributes"))
        out = companies.siren_of_interest(std, self.wh.read("dwh", "decp_siren_used"))
        obs = Observation("refresh_registry")
        out = out.observe(obs, F.count_if(F.col("euvat").isNull() & F.col("siren").isNotNull()).alias("n"))
        self._overwrite(out, "dwh", "siren_attributes", schemas.DWH_SIREN, "siren")
        step.notes["siren_without_vat"] = int(obs.get.get("n", 0) or 0)
        return self._commit(step)

    # -- financial statements -------------------------------------------------------
    def load_statements(self, path: str, header: bool = True, multi_line: bool = False) -> StepReport:
        step = self._begin("load_statements")
        raw = clean_loaded(read_delimited(self.spark, path, schemas.STAGING_STATEMENTS, sep=";", header=header,
                                          fill_missing=True, multi_line=multi_line))
        normal = statements.statements_normalized(statements.statements_long(raw))
        keyed, rejected = self._keyed(step, self._land(normal, "infogreffe_attributes"), "infogreffe_attributes",
                                      "infogreffe_uid")
        self._upsert(step, statements.statements_unique(keyed), "datalake", "infogreffe_attributes", "infogreffe_uid",
                     schemas.DATALAKE_STATEMENTS, distinct=False, rejected=rejected)
        return self._commit(step)

    def refresh_statements(self) -> StepReport:
        step = self._begin("refresh_statements")
        filed = self.wh.read("datalake", "infogreffe_attributes")
        self._overwrite(statements.dwh_statements_of_interest(filed, self.wh.read("dwh", "decp_siren_used")),
                        "dwh", "infogreffe_attributes", schemas.DWH_STATEMENTS, "infogreffe_uid")
        return self._commit(step)

    # -- goods / services codes -------------------------------------------------------
    def load_codes(self, path: str, multi_line: bool = False) -> StepReport:
        step = self._begin("load_codes")
        raw = clean_loaded(read_delimited(self.spark, path, schemas.CPV, sep="|", header=True, multi_line=multi_line),
                           schemas.CPV_WIDTHS)
        keyed, rejected = self._keyed(step, self._land(raw, "cpv_attributes"), "cpv_attributes", "codecpv")
        self._upsert(step, keyed, "datalake", "cpv_attributes", "codecpv", schemas.CPV, rejected=rejected)
        return self._commit(step)

    def refresh_codes(self) -> StepReport:
        step = self._begin("refresh_codes")
        self._overwrite(codes.cpv_refresh(self.wh.read("datalake", "cpv_attributes")), "dwh", "cpv_attributes",
                        schemas.CPV, "codecpv")
        return self._commit(step)

    # -- Entry C: reports -------------------------------------------------------------
    def refresh_reports(self) -> StepReport:
        """Per-company totals are computed once and feed both spend reports.
        Reports are stored unsorted (a table keeps no row order; ``report``
        sorts on read), which saves one range-partitioning shuffle each."""
        step = self._begin("refresh_reports")
        wh = self.wh
        marches = wh.read("dwh", "decp_marches")
        scratch = scratch_path(self.spark, "siren-totals")
        totals = materialize(reports.siren_totals(marches, wh.read("dwh", "decp_titulaires")), "siren-totals", scratch)
        try:
            names = wh.read("dwh", "siren_attributes")
            self._overwrite(reports.fact_per_suppliername(totals, names, ordered=False),
                            "dwh", "fact_per_suppliername", schemas.FACT_PER_SUPPLIERNAME)
            self._overwrite(reports.fact_per_ess(totals, names, ordered=False), "dwh", "fact_per_ess",
                            schemas.FACT_PER_ESS)
        finally:
            drop_scratch(self.spark, scratch)
        self._overwrite(reports.contracts_year_month(marches, wh.read("dwh", "time"), ordered=False),
                        "dwh", "contracts_year_month", schemas.CONTRACTS_YEAR_MONTH)
        return self._commit(step)

    def report(self, name: str) -> DataFrame:
        """A stored report in its published order."""
        df = self.wh.read("dwh", name)
        order = {"contracts_year_month": ["year_month"]}.get(name)
        return df.orderBy(*order) if order else df.orderBy(df["total_amount"].desc_nulls_first())

    def run_all(self, contracts_path: str, registry_path: str, statements_path: str, codes_path: str,
                statements_header: bool = True) -> list[StepReport]:
        """Every job in dependency order (contracts first: registry and
        statements refreshes need the companies that won contracts)."""
        return [self.load_contracts(contracts_path), self.refresh_contracts(),
                self.load_registry(registry_path), self.refresh_registry(),
                self.load_statements(statements_path, statements_header), self.refresh_statements(),
                self.load_codes(codes_path), self.refresh_codes(), self.refresh_reports()]
