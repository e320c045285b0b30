"""Problem 9: filling containers of fixed capacity by vector bin packing.

An item is a document with three sizes: tokens, one segment, and loss-bearing tokens. A container limits
all three at once; its table may name the limits. Items are placed, largest first, into the open container whose remaining room has the
largest dot product with the item's sizes (each as a share of its limit); if none has room, a new one is
opened. Only a document that alone exceeds a limit is split: into full pieces, which are containers
of their own, and one rest, which is packed like any other item.

The corpus is packed in blocks of about ``block_items`` items, cut by a hash of the key. A block leaves at
most a few unfilled containers behind, so the loss against one global packing is that of some containers
in thousands, while no task ever holds more than a block, whatever the skew of sources or lengths.

Defined results: documents of no tokens (null or empty texts) get one row with a null ``bin_id``; ties in
size are placed in the order of the key; repeated keys are separate items.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A container takes this many segments per 16 tokens of capacity, and loss-bearing tokens up to this share of it.
SEGMENT_TOKENS = 16
LOSS_SHARE = 1.0


def place(tokens: np.ndarray, loss: np.ndarray, capacity: int, max_segments: int, max_loss: float) -> np.ndarray:
    """The container number of each item, in the order given; every item fits into an empty container."""
    n = len(tokens)
    if not n:
        return np.empty(0, np.int64)
    limit = np.array([capacity, max_segments, max(max_loss, 1e-9)], dtype=np.float64)
    items = np.stack([tokens, np.ones(n), loss], axis=1) / limit
    room, ids, out = np.empty((256, 3)), np.empty(256, np.int64), np.empty(n, np.int64)
    left = opened = 0
    least, eps = items[:, 0].min(), 1e-9
    for i in range(n):
        v, k = items[i], -1
        if left:
            r = room[:left]
            score = np.where((r >= v - eps).all(axis=1), r @ v, -1.0)
            k = int(score.argmax())
            if score[k] < 0:
                k = -1
        if k < 0:
            if left == len(room):
                room, ids = np.concatenate([room, np.empty_like(room)]), np.concatenate([ids, np.empty_like(ids)])
            k, room[left], ids[left] = left, 1.0, opened
            left, opened = left + 1, opened + 1
        room[k] -= v
        out[i] = ids[k]
        if room[k, 0] < least - eps or room[k, 1] < 1 / max_segments - eps:  # nothing more can go in
            left -= 1
            room[k], ids[k] = room[left], ids[left]
    return out


def _limits(containers: DataFrame, loss_share: float) -> list[tuple[int, int, int, int]]:
    """(container_id, capacity, segments, loss) of each kind of container: a handful of rows.

    ``max_segments`` and ``max_loss`` of the table hold where it has them and they are not null; otherwise a container
    takes a segment per ``SEGMENT_TOKENS`` and ``loss_share`` of its capacity in loss-bearing tokens.
    """
    cap = F.col("capacity_tokens").cast("int")
    own = lambda name, other: (F.coalesce(F.col(name).cast("int"), other) if name in containers.columns else other).alias(name)
    rows = containers.where(cap > 0).select("container_id", cap.alias("cap"), own("max_segments", F.greatest(F.lit(1), F.floor(cap / SEGMENT_TOKENS).cast("int"))), own("max_loss", F.floor(cap * loss_share).cast("int")))
    return [tuple(r) for r in rows.distinct().orderBy("container_id", "cap").collect()]


def pack(sizes: DataFrame, containers: DataFrame, key: str = "doc_id", block_items: int = 20_000, loss_share: float = LOSS_SHARE) -> DataFrame:
    """Place all documents into containers of each capacity.

    ``sizes`` has (key, n_tokens, n_loss), ``containers`` (container_id, capacity_tokens) and may have ``max_segments``
    and ``max_loss``. Returns (container_id, key, piece_no, bin_id, n_tokens, n_loss), a row per piece. A document is
    split if its tokens alone exceed the capacity, or its loss-bearing tokens their limit: into equal shares of
    both. The loss of a piece is its share of the document's, rounded up.
    """
    items = sizes.select(F.col(key).alias("k"), F.coalesce("n_tokens", F.lit(0)).alias("n"), F.coalesce("n_loss", F.lit(0)).alias("loss"))
    spots = _limits(containers, loss_share)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("container_id"), F.lit(c).alias("cap"), F.lit(g).alias("segments"), F.lit(x).alias("most")) for i, c, g, x in spots])) if spots else F.explode(F.expr("cast(array() as array<struct<container_id int, cap int, segments int, most int>>)"))
    n_blocks = max(1, -(-items.count() // block_items))
    # products are taken in 64 bits: 262,144 tokens times a capacity of 8192 are more than 32 hold
    loss, most = F.col("loss").cast("long"), F.col("most").cast("long")
    # tokens of a full piece: the capacity, or as many as bear no more loss than is allowed
    step = F.when(loss * F.col("cap") > most * F.col("n"), F.greatest(F.lit(1), F.floor(most * F.col("n") / loss).cast("int"))).otherwise(F.col("cap"))
    both = items.withColumn("c", each).select("*", "c.*").drop("c").withColumn("step", F.least("cap", step))
    both = both.withColumn("full", F.when((F.col("n") > F.col("cap")) | (F.col("loss") > F.col("most")), F.floor(F.col("n") / F.col("step")).cast("int")).otherwise(F.lit(0)))
    kind = sizes.schema[key].dataType.simpleString()
    share = lambda n: F.least(F.col("most"), F.ceil(n * loss / F.col("n")).cast("int"))
    # rows of one key are items of their own: their number keeps the containers of their full pieces apart
    same = Window.partitionBy("container_id", "k").orderBy("n", "loss")
    whole = (
        both.where("full > 0")
        .withColumn("copy", F.row_number().over(same))
        .withColumn("piece_no", F.explode(F.expr("sequence(0, full - 1)")))
        .select("container_id", "k", "piece_no", F.concat_ws("-", "container_id", F.lit("full"), F.col("k").cast("string"), "copy", "piece_no").alias("bin_id"), F.col("step").alias("n_tokens"), share(F.col("step")).alias("n_loss"))
    )
    rest = both.select("container_id", "cap", "segments", "most", "k", F.col("full").alias("piece_no"), (F.col("n") - F.col("full") * F.col("step")).alias("left"), F.when(F.col("full") > 0, share(F.col("n") - F.col("full") * F.col("step"))).otherwise(F.least("loss", "n")).alias("loss"), "n")
    none = rest.where("n = 0").select("container_id", "k", F.lit(0).alias("piece_no"), F.lit(None).cast("string").alias("bin_id"), F.lit(0).alias("n_tokens"), F.lit(0).alias("n_loss"))
    loose = rest.where("left > 0").withColumn("block", F.pmod(F.xxhash64("k", "left"), F.lit(n_blocks)).cast("int"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["left", "k", "loss"], ascending=[False, True, False], kind="stable")
        cap, segments, most, cid, block = (pdf[c].iloc[0] for c in ("cap", "segments", "most", "container_id", "block"))
        at = place(pdf["left"].to_numpy(np.float64), pdf["loss"].to_numpy(np.float64), int(cap), int(segments), float(most))
        return pd.DataFrame({"container_id": pdf["container_id"].to_numpy(), "k": pdf["k"].to_numpy(), "piece_no": pdf["piece_no"].to_numpy(), "bin_id": [f"{cid}-{block}-{b}" for b in at], "n_tokens": pdf["left"].to_numpy(), "n_loss": pdf["loss"].to_numpy()})

    packed = loose.groupBy("container_id", "block").applyInPandas(fill, f"container_id int, k {kind}, piece_no int, bin_id string, n_tokens int, n_loss int")
    return packed.unionByName(whole).unionByName(none).withColumnRenamed("k", key)


def limit_report(placements: DataFrame, containers: DataFrame, loss_share: float = LOSS_SHARE) -> DataFrame:
    """(container_id, n_bins, most_tokens, most_segments, most_loss, n_over): the fullest containers of each kind, and how many break a limit."""
    spots = placements.sparkSession.createDataFrame(_limits(containers, loss_share), "id int, cap int, segments int, most int")
    bins = placements.where(F.col("bin_id").isNotNull()).groupBy("container_id", "bin_id").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("p"), F.sum("n_loss").alias("l"))
    met = bins.join(F.broadcast(spots), F.col("container_id") == F.col("id"))  # a handful of kinds
    over = (F.col("t") > F.col("cap")) | (F.col("p") > F.col("segments")) | (F.col("l") > F.col("most"))
    return met.groupBy("container_id").agg(F.count(F.lit(1)).alias("n_bins"), F.max("t").alias("most_tokens"), F.max("p").alias("most_segments"), F.max("l").alias("most_loss"), F.count_if(over).alias("n_over"))


def fill_report(placements: DataFrame, containers: DataFrame) -> DataFrame:
    """Per container kind: containers used, pieces placed, tokens in them and the share of the capacity they fill."""
    bins = placements.where(F.col("bin_id").isNotNull()).groupBy("container_id", "bin_id").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("p"))
    total = bins.groupBy("container_id").agg(F.count(F.lit(1)).alias("n_bins"), F.sum("p").alias("n_pieces"), F.sum("t").alias("used_tokens"))
    caps = containers.select("container_id", "capacity_tokens").distinct()
    return total.join(F.broadcast(caps), "container_id").select("container_id", "n_bins", "n_pieces", "used_tokens", (F.col("used_tokens") / (F.col("n_bins") * F.col("capacity_tokens"))).alias("fill_share"))
