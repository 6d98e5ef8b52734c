"""A resumable store of extraction cells: one outcome a document, extractor and attempt.

Outcomes are appended in committed batches, so a run that dies keeps all batches before; a cell's state follows from its
outcomes: the last one decides (done with its content, failed with its error and no content), their number is the number
of attempts. Nothing of a document is recorded while the service behind the extractors is out of reach.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.model import Model
from ..session import stored
from ..streaming.batches import BatchTable

OUTCOME = "key string, extractor string, content string, error string, at timestamp, usage map<string,double>, attempts long, batch long"


def decision(state: Column, error: Column, attempts: Column, force: bool = False, retry_failed: bool = False, retry_error: str | None = None, max_attempts: int | None = None) -> Column:
    """Why a cell runs (pending, retry, forced) or doesn't (done, failed, exhausted)."""
    wanted = F.lit(retry_failed)
    if retry_error is not None:
        wanted = wanted | F.coalesce(error.rlike(retry_error), F.lit(False))
    spent = F.lit(False) if max_attempts is None else F.coalesce(attempts, F.lit(0)) >= max_attempts
    if force:
        return F.when(state == "pending", "pending").otherwise("forced")
    return F.when(state.isin("pending", "done"), state).when(~wanted, "failed").when(spent, "exhausted").otherwise("retry")


def waves(depends: dict[str, list[str]]) -> list[list[str]]:
    """Extractors in the order of their dependencies, those that wait for the same ones together."""
    out: list[list[str]] = []
    left = dict(depends)
    while left:
        ready = [e for e, needs in left.items() if not set(needs) & set(left)]
        if not ready:
            raise ValueError(f"extractors wait for each other: {sorted(left)}")
        out.append(ready)
        for e in ready:
            del left[e]
    return out


class CellStore:
    """Cells by key and extractor; ``depends`` lists the extractors with those whose content they need."""

    def __init__(self, spark: SparkSession, path: str, depends: dict[str, list[str]]):
        self.spark, self.depends = spark, depends
        self.log = BatchTable(spark, path)
        self.order = [e for wave in waves(depends) for e in wave]

    def cells(self) -> DataFrame:
        """key, extractor, content, error, at, usage, attempts of all cells that were ever tried."""
        rows = self.log.read(StructType.fromDDL(OUTCOME))
        last = F.max_by(F.struct("content", "error", "at", "usage", "batch"), "batch").alias("last")
        return rows.groupBy("key", "extractor").agg(F.sum("attempts").alias("attempts"), last).select("key", "extractor", "last.content", "last.error", "last.at", "last.usage", "attempts", "last.batch")

    def states(self, keys: DataFrame, selected: list[str] | None = None) -> DataFrame:
        """Each key's cells with their state: pending, done or failed."""
        names = F.explode(F.array(*map(F.lit, selected or self.order))).alias("extractor")
        all_ = keys.select(F.col(keys.columns[0]).cast("string").alias("key")).distinct().select("key", names)
        # Joins of a store merge: its files are so much smaller than its rows that Spark takes them for tables to broadcast.
        out = all_.join(self.cells().hint("merge"), ["key", "extractor"], "left")
        state = F.when(F.col("error").isNotNull(), "failed").when(F.col("content").isNotNull(), "done").otherwise("pending")
        return out.withColumn("state", state).withColumn("attempts", F.coalesce("attempts", F.lit(0)))

    def record(self, outcomes: DataFrame, batch: int) -> bool:
        """Outcomes (key, extractor, content, error, usage) of one attempt each; failures keep no content and no usage."""
        failed = F.col("error").isNotNull()
        rows = outcomes.select(
            F.col("key").cast("string").alias("key"), "extractor", F.when(~failed, F.col("content")).alias("content"), "error", F.current_timestamp().alias("at"),
            (F.when(~failed, F.col("usage")) if "usage" in outcomes.columns else F.lit(None)).cast("map<string,double>").alias("usage"), F.lit(1).cast("long").alias("attempts"), F.lit(batch).cast("long").alias("batch"),
        )
        return self.log.append(rows, batch)

    def compact(self) -> None:
        """One snapshot in place of all batches so far."""
        last = max(self.log.commits(), default=-1)
        if last >= 0:
            self.log.append(self.cells().select(*StructType.fromDDL(OUTCOME).names), last + 1, snapshot=True)

    def run(self, keys: DataFrame, extract: Callable[[DataFrame], DataFrame], selected: list[str] | None = None, batches: int = 1, **policy) -> dict[str, int]:
        """Runs the cells that the policy (see ``decision``) picks, and returns how many cells met each end.

        Keys are dealt into ``batches``, extractors run in waves by their dependencies, and each wave of a batch is
        committed: what a kill loses is one wave of one batch. ``extract`` gets key, extractor, attempts and context (the
        contents of done dependencies by name) and returns key, extractor, content, error, and unreachable: true where the
        service did not answer, which ends the run and records nothing for that cell. A cell whose dependencies are not
        done waits and is no attempt.
        """
        chosen = selected or self.order
        total = dict.fromkeys(("done", "failed", "waiting", "unreachable"), 0)
        batch = max(self.log.commits(), default=-1) + 1
        for part in range(batches):
            own = keys.where(F.pmod(F.xxhash64(F.col(keys.columns[0]).cast("string")), F.lit(batches)) == part)
            # What runs is decided once: a cell that fails in an earlier wave is not tried again in this run.
            work = stored(self.states(own, chosen).withColumn("reason", decision(F.col("state"), F.col("error"), F.col("attempts"), **policy)).where(F.col("reason").isin("pending", "retry", "forced")).select("key", "extractor", "attempts"), "work")
            for wave in waves({e: [d for d in self.depends[e] if d in chosen] for e in self.order if e in chosen}):
                now = work.where(F.col("extractor").isin(wave))
                done = self.cells().where(F.col("content").isNotNull()).groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("extractor", "content"))).alias("context"))
                needs = F.create_map(*(x for e in self.order for x in (F.lit(e), F.array(*map(F.lit, self.depends[e])).cast("array<string>"))))
                met = now.join(done.hint("merge"), "key", "left").withColumn("context", F.coalesce("context", F.create_map().cast("map<string,string>")))
                met = met.withColumn("ready", F.forall(needs[F.col("extractor")], lambda d: F.map_contains_key("context", d)))
                out = stored(extract(met.where("ready").drop("ready")), "outcomes")
                lost = F.coalesce(F.col("unreachable"), F.lit(False)) if "unreachable" in out.columns else F.lit(False)
                told = out.agg(F.count_if(lost).alias("lost"), F.count_if(~lost & F.col("error").isNull()).alias("done"), F.count_if(~lost & F.col("error").isNotNull()).alias("failed")).first()
                total["waiting"] += met.where("NOT ready").count()
                for end, n in (("done", told["done"]), ("failed", told["failed"]), ("unreachable", told["lost"])):
                    total[end] += n
                if told["done"] + told["failed"]:
                    self.record(out.where(~lost), batch)
                    batch += 1
                if told["lost"]:
                    return total
        return total

    def load(self, key: str, extractor: str, model: Model):
        """A done cell's content as a record of its model, defaults filled in; None where there is none."""
        rows = self.cells().where((F.col("key") == key) & (F.col("extractor") == extractor) & F.col("content").isNotNull())
        row = rows.select(model.resolved(F.from_json("content", model.wire_schema())).alias("r")).first()
        return row and row["r"]

    def documents(self, keys: DataFrame, compose: Callable[[dict[str, Column]], Column] | None = None) -> DataFrame:
        """One row a key: each extractor's content, error and attempts, has_errors, and what ``compose`` makes of the contents."""
        rows = self.states(keys)
        of = lambda e, x: F.max(F.when(F.col("extractor") == e, F.col(x)))
        cells = [of(e, x).alias(f"{e}_extractor_{x}") for e in self.order for x in ("content", "error", "attempts")]
        wide = rows.groupBy("key").agg(*cells, F.bool_or(F.col("state") == "failed").alias("has_errors"))
        if compose is None:
            return wide
        return wide.withColumn("extraction_output", compose({e: F.col(f"{e}_extractor_content") for e in self.order}))


def looked_up(spark: SparkSession, path: str, keys: DataFrame, look: Callable[[DataFrame], DataFrame], batches: int = 1) -> DataFrame:
    """(key, content): a cache of lookups. Only keys that were never answered are looked up, and each batch is kept before the next begins."""
    store = CellStore(spark, path, {"lookup": []})
    store.run(keys, look, batches=batches, retry_failed=True)
    return store.cells().where(F.col("content").isNotNull()).select("key", "content")
