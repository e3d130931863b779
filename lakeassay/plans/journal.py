"""Answers of a model, kept under the prompt they answer, so that no prompt is asked again for a lost run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeassay.operators.insights import respond_with
from lakeassay.sources import tables

#: Prompts asked between two commits of their answers.
COMMIT_EVERY = 100
_LAYOUT = "prompt_hash string, asked string, prompt string, raw_response string, error string, answered_at timestamp"


class Journal:
    """A table of every prompt asked: its hash, whom, the answer or the error, and when. Rows are only ever added.

    `asked` names the model, so that another model is asked anew. One writer at a time.
    """

    def __init__(self, spark: SparkSession, table: str, asked: str = "", fmt: str = "parquet") -> None:
        self._spark, self.table, self._asked, self._fmt = spark, table, asked, fmt

    def answers(self, prompt_rows: DataFrame) -> DataFrame:
        """`prompt_rows` with `raw_response` and, for those that only ever failed, the latest `error`; null for those not asked."""
        hashed = prompt_rows.withColumn("prompt_hash", F.sha2("prompt", 256))
        if not tables.exists(self._spark, self.table):
            return hashed.withColumns({"raw_response": F.lit(None).cast("string"), "error": F.lit(None).cast("string")})
        known = self._spark.table(self.table).where(F.col("asked") == self._asked).groupBy("prompt_hash").agg(
            F.min(F.when(F.col("error").isNull(), F.struct("answered_at", "raw_response"))).alias("first"),
            F.max(F.when(F.col("error").isNotNull(), F.struct("answered_at", "error"))).alias("failure"))
        found = hashed.join(known, "prompt_hash", "left")
        error = F.when(F.col("first").isNull(), F.col("failure.error"))
        return found.withColumns({"raw_response": F.col("first.raw_response"), "error": error}).drop("first", "failure")

    def ask(self, prompt_rows: DataFrame, respond: Callable[[str], str], at: Column, *, commit_every: int = COMMIT_EVERY) -> int:
        """Ask for what has no answer yet, each different prompt once; returns how many were asked.

        Answers are committed after every `commit_every` prompts or so: what a lost run has asked since then is asked again, no
        more. Prompts that raised have a row with the error, and are asked again by the next call.
        """
        if not tables.exists(self._spark, self.table):
            # Made before the first answers, which may be lost halfway.
            tables.append(self._spark.createDataFrame([], _LAYOUT), self.table, fmt=self._fmt)
        known = self._spark.table(self.table).where((F.col("asked") == self._asked) & F.col("error").isNull())
        with tables.Staging(self._spark) as staging:
            wanted = prompt_rows.select(F.sha2("prompt", 256).alias("prompt_hash"), "prompt").dropDuplicates(["prompt_hash"])
            missing = staging.stage(wanted.join(known, "prompt_hash", "left_anti"))
            count = missing.count()
            rounds = -(-count // commit_every)
            turn = F.pmod(F.xxhash64("prompt_hash"), F.lit(max(rounds, 1)))
            for i in range(rounds):
                batch = missing.where(turn == i).repartition(max(1, min(commit_every, self._spark.sparkContext.defaultParallelism)))
                done = respond_with(batch, respond).withColumns({"asked": F.lit(self._asked), "answered_at": at})
                tables.append(done.select(*[c.split()[0] for c in _LAYOUT.split(", ")]), self.table, fmt=self._fmt)
        return count
