"""The monthly run: staging to features in one batch that is published whole or not at all."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.contracts import CONTRACTS, ContractError, enforce_figures, row_figures
from ledgerloom.operators.measure import Measure
from ledgerloom.operators.rules import RuleError, is_stale, parent_column, rule_text, with_broken_rules
from ledgerloom.operators.validation import REASON, quarantine_rows
from ledgerloom.plans.cleanse import CLEANSERS, TYPED, classify, staged_columns, typed
from ledgerloom.plans.customer_dim import dimension_source, initial_dimension, new_versions, split_versions
from ledgerloom.plans.facts import baseline_scenario, fact_credit_event, fact_exposure, fact_rating_history
from ledgerloom.plans.features import customer_risk_features, lower_bound
from ledgerloom.schemas import dim_branch, dim_macro_scenario, dim_product
from ledgerloom.session import materialize
from ledgerloom.sources.calendar import dim_date, key_to_date
from ledgerloom.sources.staging import staging_lines
from ledgerloom.sources.warehouse import Batch, Warehouse, bucket_slot, month_slot, stage_lines

DEFAULT_NAME = "ECL_MONTHLY_PIPELINE"
LOAD_NAME = "SYNTHETIC_DATA_LOAD"
CLEANSE_ORDER = ("customers", "accounts", "transactions", "credit_bureau")  # parents first


def load_staging(warehouse: Warehouse, csv_dir: str, load_ts: datetime, pipeline_name: str = LOAD_NAME) -> int:
    """Stage every table's CSV file as a new batch and return its id; absent files stage nothing, damaged lines are quarantined."""
    batch = warehouse.open_batch(pipeline_name, load_ts)
    rows, damaged = 0, 0
    for spec in CLEANSERS.values():
        parsed = staging_lines(warehouse.spark, f"{csv_dir}/{spec.source}.csv", spec.source)
        found = stage_lines(batch, parsed, spec.source, f"load{batch.batch_id}", load_ts)
        rows, damaged = rows + found[0], damaged + found[1]
    batch.publish()
    batch.close("SUCCESS", rows, damaged)
    return batch.batch_id


class MonthlyRun:
    """State shared by the steps of one run."""

    def __init__(self, warehouse: Warehouse, as_of_key: int, pipeline_name: str, run_ts: datetime,
                 calendar: tuple[str, str], buckets: int, grain: str, rules: DataFrame | None = None):
        self.warehouse, self.spark = warehouse, warehouse.spark
        self.as_of_key, self.grain, self.buckets = as_of_key, grain, buckets
        self.calendar = tuple(key_to_date(int(day.replace("-", ""))) for day in calendar)
        self.calendar_start = self.calendar[0]
        self.dates = dim_date(self.spark, *calendar)
        self.run_ts = F.lit(run_ts).cast("timestamp")
        self.batch: Batch = warehouse.open_batch(pipeline_name, run_ts)
        self.batch_id = self.batch.batch_id
        self.quarantined = 0
        # The catalogue is small.
        self.rules = [] if rules is None else rules.where("is_active").collect()

    # --- steps: each returns the number of rows it handled -------------------------------

    def cleanse(self, table: str) -> int:
        """Rows and rejections are counted where the verdicts are written, and broken row contracts where the
        table is; keys are unique because one row per key was chosen."""
        spec = CLEANSERS[table]
        staged, slots = self.batch.unprocessed(spec.source)
        parent = self.batch.read(spec.parent[0]) if spec.parent else None
        columns = [*staged_columns(table), "source_system", "batch_id"]
        verdict = classify(table, staged.select(*columns), parent)
        rules = [r for r in self.rules if r.target_table == spec.source]
        warned = [r for r in rules if r.severity != "ERROR" and r.rule_type != "FRESHNESS"]
        self._check_freshness([r for r in rules if r.rule_type == "FRESHNESS"])
        if rules:
            verdict = self._with_rules(verdict, rules)
        verdict = verdict.withColumn("rejected", F.col(REASON).isNotNull())
        counted = Measure(rows=F.count("*"), rejected=F.count_if("rejected"),
                          **{f"rule_{r.rule_id}": F.count_if(F.array_contains("warned", r.rule_id)) for r in warned})
        # A rejected row goes on as it was sent and an accepted one as it was converted: neither needs the other form.
        sent, made = spec.convert().keys(), [c for c in verdict.columns if c.startswith(TYPED)]
        verdict = verdict.withColumns({**{c: F.when(F.col("rejected"), F.col(c)) for c in sent},
                                       **{c: F.when(~F.col("rejected"), F.col(c)) for c in made}})
        classified = materialize(counted.on(verdict), f"verdict-{table}", partition_by=["rejected"])
        self._warn([(r, counted[f"rule_{r.rule_id}"]) for r in warned])
        rows, rejected = counted["rows"], counted["rejected"]
        self.quarantined += rejected
        if rejected:
            self.batch.write("quarantine", quarantine_rows(classified.where("rejected"), spec.source, columns, self.batch_id, self.run_ts),
                             f"run{self.batch_id}-{table}", sparse=True)
        if rows > rejected:
            accepted = typed(table, classified.where(~F.col("rejected")), self.batch_id, self.run_ts)
            keys = list(spec.keys)
            moves = table == "transactions"
            slot = month_slot(F.col("transaction_date")) if moves else bucket_slot(keys, self.buckets)
            enforce_figures(CONTRACTS[table], self.batch.upsert(table, accepted, keys, slot, moves, **row_figures(CONTRACTS[table])))
        self.batch.consume(spec.source, slots)
        return rows

    def _with_rules(self, verdict: DataFrame, rules: list) -> DataFrame:
        """Rows that the fixed validation accepts and an ERROR rule does not are rejected under that rule."""
        parents = {parent_column(r.rule_expression)[0] for r in rules if r.rule_type == "REFERENTIAL"}
        found = with_broken_rules(verdict, rules, {t: self.batch.read(t) for t in parents})
        text = F.lit(None).cast("string")
        for rule in rules:
            text = F.when(F.col("rule_id") == rule.rule_id, rule_text(rule)).otherwise(text)
        return found.withColumns({REASON: F.coalesce(REASON, text), "rule_id": F.when(F.col(REASON).isNull(), F.col("rule_id"))})

    def _check_freshness(self, rules: list) -> None:
        today = self.batch.run_ts.date()
        for rule in rules:
            slots = [s for (t, _), s in self.batch.state.items() if t == rule.target_table]
            if is_stale(rule.rule_expression, slots, today):
                if rule.severity == "ERROR":
                    raise RuleError(f"{rule.target_table} {rule_text(rule)}")
                self._warn([(rule, 1)])

    def _warn(self, found: list) -> None:
        self.warehouse.log_steps([(self.batch_id, f"warning_rule_{rule.rule_id}", _now(), n, "WARNING") for rule, n in found if n])

    def customer_history(self) -> int:
        customers = self.batch.read("customers").where(F.col("batch_id") == self.batch_id)
        source = dimension_source(customers, self.batch.read("credit_bureau"))
        if not any(t == "dim_customer" for t, _ in self.batch.state):
            return self.batch.write("dim_customer", initial_dimension(source, self.run_ts), "current")["rows"]
        counted = Measure(rows=F.count("*"))
        inserted = materialize(counted.on(new_versions(source, self.batch.read("dim_customer"), self.run_ts)), "versions")
        if counted["rows"]:
            stays, closes = split_versions(self._current_customers(), inserted, self.run_ts)
            # History only grows; of the existing files just the current slot is written again.
            self.batch.write("dim_customer", closes, f"closed{self.batch_id}")
            self.batch.write("dim_customer", stays.unionByName(inserted.select(*stays.columns)), "current")
        return counted["rows"]

    def _current_customers(self) -> DataFrame:
        return self.batch.read("dim_customer", slots=lambda s: s == "current")

    def _publish_fact(self, table: str, df: DataFrame, slot) -> int:
        """Write first, check what was measured; nothing is visible before the batch publishes.

        Customers come from a join with the current dimension, dates are checked against the calendar's ends.
        """
        found = self.batch.write(table, df, slot, **row_figures(CONTRACTS[table]))
        enforce_figures(CONTRACTS[table], found)
        if found["rows"] and not self.calendar[0] <= found["low"] <= found["high"] <= self.calendar[1]:
            raise ContractError(f"contract violated: {table} reference:date_key->dim_date: {found['low']} to {found['high']}")
        return found["rows"]

    def exposure(self) -> int:
        scenario = baseline_scenario(dim_macro_scenario(self.spark)).first()["scenario_key"]
        fact = fact_exposure(self.batch.read("accounts"), self.batch.read("transactions"), self._current_customers(),
                             dim_product(self.spark), dim_branch(self.spark), scenario, key_to_date(self.as_of_key),
                             self.batch_id, self.calendar_start)
        # A second run for the same date takes the place of the first.
        return self._publish_fact("fact_exposure", fact, f"d{self.as_of_key}")

    def _run_month_slot(self):
        return F.concat(F.lit("m"), F.floor(F.col("date_key") / 100).cast("string"), F.lit(f"-run{self.batch_id}"))

    def credit_events(self) -> int:
        fact = fact_credit_event(self.batch.read("transactions"), self.batch.read("accounts"), self._current_customers(),
                                 dim_product(self.spark), self.dates, self.batch_id)
        return self._publish_fact("fact_credit_event", fact, self._run_month_slot())

    def ratings(self) -> int:
        fact = fact_rating_history(self.batch.read("credit_bureau"), self._current_customers(), self.dates, self.batch_id)
        return self._publish_fact("fact_credit_rating_history", fact, self._run_month_slot())

    def features(self) -> int:
        low = lower_bound(key_to_date(self.as_of_key))
        recent_events = self.batch.read("fact_credit_event", slots=lambda s: int(s[1:7]) >= low // 100)
        recent_exposure = self.batch.read("fact_exposure", slots=lambda s: low <= int(s[1:9]) <= self.as_of_key)
        rows = customer_risk_features(
            recent_exposure, self.batch.read("fact_credit_rating_history"), recent_events, self._current_customers(),
            self.as_of_key, self.batch_id, self.run_ts, self.grain)
        return self.batch.write("customer_risk_features", rows, f"d{self.as_of_key}")["rows"]

    def plan(self) -> list:
        """(step name, action) in order; later steps read what earlier ones wrote."""
        cleansing = [(f"cleanse_{t}", lambda t=t: self.cleanse(t)) for t in CLEANSE_ORDER]
        return cleansing + [
            ("merge_dim_customer_scd2", self.customer_history),
            ("load_fact_exposure", self.exposure),
            ("load_fact_credit_event", self.credit_events),
            ("load_fact_credit_rating_history", self.ratings),
            ("compute_risk_features", self.features),
        ]

    def execute(self) -> int:
        """Run the steps; each is logged as RUNNING before it begins, together with the end of the one before."""
        step, ingested, ended = None, 0, []
        try:
            for step, action in self.plan():
                self.warehouse.log_steps([*ended, (self.batch_id, step, _now(), None, "RUNNING")])
                ended = []
                ingested = action()
                ended = [(self.batch_id, step, _now(), ingested, "SUCCESS")]
            self.batch.publish()
        except Exception as problem:
            self.warehouse.log_steps([*ended, (self.batch_id, step, _now(), None, "FAILED")])
            self.batch.close("FAILED", error=str(problem)[:4000], ended_at=_now())
            raise
        self.warehouse.log_steps(ended)
        self.batch.close("SUCCESS", ingested, self.quarantined, ended_at=_now())
        return self.batch_id


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def run_full_etl(warehouse: Warehouse, as_of_key: int, pipeline_name: str = DEFAULT_NAME,
                 run_ts: datetime | None = None, calendar: tuple[str, str] = ("2018-01-01", "2030-12-31"),
                 buckets: int = 8, grain: str = "account_rows", rules: DataFrame | None = None) -> int:
    """Run all steps for one as-of date and return the batch id. Drift detection is separate.

    ``buckets`` is the number of hash slots of the keyed cleansed tables: choose it so that a
    slot is a few gigabytes, and keep it for the life of the warehouse. With a catalogue of ``rules``
    its ERROR rules block rows (or the run) besides the fixed validation, and WARNING rules are logged as steps.
    """
    return MonthlyRun(warehouse, as_of_key, pipeline_name, run_ts or _now(), calendar, buckets, grain, rules).execute()


def verify_run(warehouse: Warehouse, pipeline_name: str) -> dict:
    """Outcome of the newest run of that name; raises unless it succeeded with rows."""
    latest = (warehouse.run_log().where(F.col("pipeline_name") == pipeline_name)
              .orderBy(F.desc("batch_id")).limit(1).collect())
    if not latest:
        raise RuntimeError(f"no run of {pipeline_name} is logged")
    row = latest[0].asDict()
    if row["status"] != "SUCCESS":
        raise RuntimeError(f"run {row['batch_id']} ended as {row['status']}: {row['error_message']}")
    if not row["rows_ingested"]:
        raise RuntimeError(f"run {row['batch_id']} succeeded but produced no rows")
    return row
