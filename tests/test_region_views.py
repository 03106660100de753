"""Alignments under each other against a layout made place by place."""

import random

import pytest
from pyspark.sql import functions as F

from loomspan.functions import spans as S
from loomspan.operators import regions


def cells(spans, seq):
    """Places and bases of one alignment, in order."""
    places = [p for s, e in spans for p in range(s, e + 1)]
    out, at, last = [], 0, places[0] - 1
    for k, part in enumerate(seq.replace(":", "").split("+")):
        for j, base in enumerate(part):
            if k % 2:
                out.append((last, j + 1, base))
            else:
                last = places[at]
                out.append((last, 0, base))
                at += 1
    return out


def brute(rows, low, high):
    hits = [(r, cells(r[2], r[3])) for r in rows if r[2][0][0] <= high and r[2][-1][1] >= low]
    columns = sorted({(p, k) for _, c in hits for p, k, _ in c})
    mark = {}
    for (p, _), (q, k) in zip(columns, columns[1:], strict=False):
        if q - p > 1:
            mark[q, k] = f"  <-  {q - p - 1:,} bp gap ->  "
    best = {}
    for x in columns:
        bases = [b for _, c in hits for p, k, b in c if (p, k) == x]
        best[x] = max(sorted(set(bases), key="ACGTN".index), key=bases.count)
    top = "".join(mark.get(x, "") + best[x] for x in columns)
    out = [(None, top)] if hits else []
    for r, own in hits:
        have = {(p, k): b for p, k, b in own}
        text = "".join(mark.get(x, "") + have.get(x, " ") for x in columns if x <= max(have))
        out.append((r[0], text.ljust(len(top))))
    return sorted(out, key=str)


@pytest.mark.parametrize("insertions", [True, False])
def test_views(spark, insertions):
    rng = random.Random(6)
    rows = []
    for k in range(40):
        spans, seq = [], []
        at = rng.choice([10, 14, 30, 2500])
        for _ in range(rng.randint(1, 3)):
            n = rng.randint(2, 8)
            spans.append((at, at + n - 1))
            seq.append("".join(rng.choice("ACGTN") for _ in range(n)))
            at += n + rng.choice([3, 1200])
        text = ":".join(seq)
        if rng.random() < 0.4:
            cut = rng.randint(1, len(seq[0]) - 1)
            text = f"{text[:cut]}+{'GT'[: rng.randint(1, 2)]}+{text[cut:]}"
        rows.append((k, rng.choice("12"), spans, text))
    data = [(k, "a", c, ", ".join(f"{s}-{e}" for s, e in x), t) for k, c, x, t in rows] + [(99, "a", "1", "", "A"), (98, "a", "1", "1-2", None), (97, "a", None, "1-2", "AA")]
    data.append(data[0])
    df = spark.createDataFrame(data, "seqnum long, mate string, chr string, t string, seq string").withColumn("spans", S.parse(F.col("t")))
    places = [(1, "1", 12, 40), (2, "2", 12, 40), (3, "1", 2490, 2600), (4, "9", 1, 9), (5, "1", 900_000, 900_001)]
    out = regions.region_views(df, spark.createDataFrame(places, "region long, chr string, low long, high long"), insertions=insertions).collect()
    for region, chromosome, low, high in places:
        plain = [(k, c, x, t if insertions else "".join(t.split("+")[::2])) for k, c, x, t in rows if c == chromosome]
        got = sorted(((r.seqnum, r.text) for r in out if r.region == region), key=str)
        assert got == brute(plain, low, high)
        assert len({len(t) for _, t in got}) <= 1
    assert {r.kind for r in out} == {"alignment", "consensus"} and all(r.start for r in out if r.kind == "alignment")
