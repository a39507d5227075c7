"""Mixing sources to target weights.

Slots of one block each are given to sources by golden-ratio points mapped
through the cumulative weights, so that every prefix of the schedule keeps the
shares closely. The texts of a source, shuffled by a hash, form an endless
stream (one pass after another, each in another order) that is cut into blocks
of equal tokens; slot j of a source takes its block j.

Running totals come from counts per (source, pass, hash bucket) and a window
within each bucket of some ``ORDER_ROWS`` texts: no source is ever ordered by
one task. The schedule is computed in chunks, again with only counts per chunk
ordered together. Of the sources only their numbers and weights reach the
driver, sixteen bytes each; names and totals stay in a table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import number_rows
from ..functions.text import strip
from ..session import materialise

GOLDEN = (math.sqrt(5) - 1) / 2
BLOCK_TOKENS = 2048  # a mixture of n such blocks keeps every share within about 1 / n
ORDER_ROWS = 65_536
CHUNK = 4096


def source_key(c: Column) -> Column:
    """A source's name without regard to case, outer blanks and the kind of dash."""
    return F.regexp_replace(F.lower(strip(c)), r"[\s\-_]+", "_")


class Mixture:
    """sizes: doc_id, source, n_tokens; targets: source, target_share, max_repeats.

    Sources outside targets are left out, as are texts without tokens and
    targets whose share is null or not positive. A target without texts gets
    nothing and the others keep their proportions. A null max_repeats counts
    as 1. A doc_id that occurs twice in sizes is two texts.
    """

    def __init__(self, sizes: DataFrame, targets: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: int = 0):
        wanted = targets.select(source_key(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("share"), F.coalesce(F.col("max_repeats").cast("int"), F.lit(1)).alias("repeats"))
        wanted = wanted.filter("source IS NOT NULL AND share > 0 AND repeats > 0").groupBy("source").agg(F.sum("share").alias("share"), F.max("repeats").alias("repeats"))
        self.wanted = materialise(wanted, "wanted")
        mine = sizes.select("doc_id", source_key(F.col("source")).alias("source"), "n_tokens").filter("n_tokens > 0")
        self.sizes = materialise(mine.join(self.wanted.select("source"), "source", "left_semi").select("doc_id", "source", "n_tokens"), "sizes")
        self.seed, self.block = seed, block_tokens
        totals = self.sizes.groupBy("source").agg(F.sum("n_tokens").alias("total"), F.count("*").alias("n_texts"))
        held = self.wanted.join(totals, "source")
        whole = held.agg(F.sum("share")).first()[0]
        #: source, share, repeats, total, n_texts, weight and number of the sources that have texts.
        self.live = materialise(number_rows(held.withColumn("weight", F.col("share") / F.lit(whole)), "source", name="number"), "live")
        limit, texts = self.live.agg(F.min(F.col("total") * F.col("repeats") / F.col("weight")), F.sum("n_texts")).first()
        #: Tokens of the largest mixture in which no text is used too often.
        self.size = limit or 0
        self.slots = math.ceil(self.size / self.block)
        self.buckets = math.ceil((texts or 1) / ORDER_ROWS)

    def schedule(self) -> DataFrame:
        """(slot, source, block): which block of which source each slot takes."""
        spark = self.sizes.sparkSession
        weights = self.live.select("number", "weight").toPandas().sort_values("number").weight.to_numpy()
        sent = spark.sparkContext.broadcast(np.cumsum(weights)[:-1])

        def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                u = (f.id.to_numpy() + 0.5) * GOLDEN
                yield pd.DataFrame({"slot": f.id, "number": np.searchsorted(sent.value, u - np.floor(u), "right") + 1})

        drawn = spark.range(self.slots).mapInPandas(pick, "slot long, number long")
        slots = drawn.join(self.live.select("number", "source"), "number").withColumn("chunk", F.floor(F.col("slot") / CHUNK))
        before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        base = slots.groupBy("source", "chunk").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
        within = Window.partitionBy("source", "chunk").orderBy("slot")
        return slots.withColumn("nth", F.row_number().over(within) - 1).join(base.drop("n"), ["source", "chunk"]).select("slot", "source", (F.col("base") + F.col("nth")).alias("block"))

    def stream(self) -> DataFrame:
        """(source, doc_id, use, n_tokens, block, offset): texts in shuffled order, pass by pass.

        offset is where the text starts in the source's stream.
        """
        passes = F.least(F.col("repeats"), F.greatest(F.lit(1), F.ceil(F.col("weight") * F.lit(float(self.size)) / F.col("total")))).cast("int")
        times = self.live.select("source", passes.alias("passes"))
        rows = self.sizes.join(times, "source").select("source", "doc_id", "n_tokens", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("use"))
        h = F.xxhash64("doc_id", "use", F.lit(self.seed))
        rows = rows.withColumn("h", h).withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 32), F.lit(self.buckets)))
        part = Window.partitionBy("source", "use", "bucket")
        order = part.orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = rows.groupBy("source", "use", "bucket").agg(F.sum("n_tokens").alias("t"))
        early = Window.partitionBy("source").orderBy("use", "bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("base", F.coalesce(F.sum("t").over(early), F.lit(0))).drop("t")
        placed = rows.withColumn("upto", F.sum("n_tokens").over(order)).join(sums, ["source", "use", "bucket"])
        offset = (F.col("base") + F.col("upto") - F.col("n_tokens")).alias("offset")
        return placed.select("source", "doc_id", "use", "n_tokens", offset).withColumn("block", F.floor(F.col("offset") / self.block))

    def mixed(self) -> DataFrame:
        """(slot, position, source, doc_id, use, n_tokens): the mixture in order.

        A text belongs to the block in which it starts and is never cut. use
        counts the repeats of a text from 0.
        """
        found = self.schedule().join(self.stream(), ["source", "block"])
        within = Window.partitionBy("slot").orderBy("offset", "doc_id")
        return found.select("slot", (F.row_number().over(within) - 1).alias("position"), "source", "doc_id", "use", "n_tokens")

    def report(self) -> DataFrame:
        """(source, target_share, actual_share, n_tokens, n_available, n_uses, most_uses), one row per wanted source."""
        per_text = self.mixed().groupBy("source", "doc_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("uses"))
        got = per_text.groupBy("source").agg(F.sum("t").alias("n_tokens"), F.sum("uses").alias("n_uses"), F.max("uses").alias("most_uses"))
        got = materialise(got, "got")
        whole = got.agg(F.sum("n_tokens")).first()[0] or 1
        named = self.wanted.select("source", F.col("share").alias("target_share"), F.col("repeats").alias("max_repeats"))
        out = named.join(self.live.select("source", F.col("total").alias("n_available")), "source", "left").join(got, "source", "left")
        out = out.fillna(0, ["n_available", "n_tokens", "n_uses", "most_uses"]).select("source", "target_share", "n_available", "max_repeats", "n_tokens", "n_uses", "most_uses")
        return out.withColumn("actual_share", F.col("n_tokens") / F.lit(whole))
