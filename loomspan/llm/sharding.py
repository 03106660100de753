"""Operator 10: rendezvous sharding by a stable key, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.llm.ranks import gapless


def rendezvous(key: str, weights: Sequence[float]) -> Column:
    """The shard that wins the key: the least of -ln(u) / weight, u hashed from key and shard.

    A shard's draw depends on the key and that shard alone, so appending a shard only moves keys
    that the new shard wins, and changing a weight moves about its share. Ties (none in practice)
    go to the smaller shard; a shard of weight 0 gets nothing; a null key is hashed as null."""
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be at least 0, one of them more")
    draws = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            # 53 bits of the hash, moved into the open interval (0, 1)
            bits = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(shard), F.lit("shard")), 11)
            u = (bits.cast("double") + 0.5) / F.lit(float(2**53))
            draws.append(F.struct((-F.ln(u) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard")))
    return (draws[0] if len(draws) == 1 else F.least(*draws))["shard"]


def sharded(
    docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """docs with size, text_crc32, law, shard, slot and grown_shard (columns of such names are replaced).

    The law is `key`: the key and the weights alone decide, equal keys meet in one shard, and
    `grown` (by default one more shard of the last weight) takes rows only into the new shard.
    size: UTF-8 bytes of the text plus 1; a null text has size 1 and CRC 0. slot numbers the rows of a
    shard from 0 without gaps, by slices of the key's hash, so no task holds a whole shard. Repeated
    rows each have a slot of their own. An empty table gives an empty result."""
    added = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    grown = [*weights, weights[-1]] if grown is None else grown
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    out = docs.drop(*added).withColumns(
        {
            "size": F.octet_length(body).cast("long") + 1,
            "text_crc32": F.crc32(body),
            "law": F.lit("key"),
            "shard": rendezvous(key, weights).cast("int"),
            "grown_shard": rendezvous(key, grown).cast("int"),
        }
    )
    return gapless(out, ["shard"], [key, "text_crc32", "size"], "slot")


def op10_rendezvous(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    slim = sharded(docs, [1.0] * 8).drop("text")
    return slim.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
