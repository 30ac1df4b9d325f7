"""Two's-complement decimals of any length, and numbers of the rows of a whole result."""

import base64
import random
from decimal import Decimal, localcontext

from pyspark.sql import functions as F

from arborpay.functions.ids import numbered
from arborpay.functions.money import unscaled_decimal


def test_decimals_of_any_number_of_bytes(spark):
    rng = random.Random(1)
    values = [0, -1, -5, 2**63, -(2**63), 2**64 - 1, -(2**64), 10**38 - 1, 1 - 10**38, 10**38, -(10**38), 2**127 - 1, -(2**127)]
    values += [rng.randrange(-(10**k), 10**k) for k in range(1, 39) for _ in range(4)]
    rows = [(str(v), base64.b64encode(v.to_bytes((v.bit_length() + 8) // 8 + more, "big", signed=True)).decode()) for v in values for more in (0, 1, 3, 9)]
    rows += [("", base64.b64encode(b"").decode()), ("", base64.b64encode((2**130).to_bytes(20, "big")).decode()), ("", None)]
    got = spark.createDataFrame(rows, "v string, sent string").select("v", *[unscaled_decimal(F.col("sent"), k).cast("string").alias(f"s{k}") for k in (0, 4)]).collect()
    assert len(got) == len(rows)
    with localcontext() as context:
        context.prec = 60
        for r in got:
            if not r["v"] or abs(int(r["v"])) >= 10**38:
                assert r["s0"] is None and r["s4"] is None
            else:
                assert int(r["s0"]) == int(r["v"]) and Decimal(r["s4"]) == Decimal(r["v"]) / 10_000


def test_rows_are_numbered_over_all_partitions(spark, ws):
    rows = spark.range(3000).select(((F.col("id") * 7919) % 3001).alias("v"), (F.col("id") % 5).alias("w")).repartition(7)
    got = numbered(ws, rows, [F.desc("w"), F.asc("v")]).collect()
    want = sorted(((r["v"], r["w"]) for r in got), key=lambda x: (-x[1], x[0]))
    assert [(r["v"], r["w"]) for r in sorted(got, key=lambda r: r["row_no"])] == want
    assert sorted(r["row_no"] for r in got) == list(range(1, 3001))
    ties = numbered(ws, spark.range(500).select(F.lit(1).alias("x")), [F.asc("x")])
    assert sorted(r["row_no"] for r in ties.collect()) == list(range(1, 501))
    assert numbered(ws, rows.where("false"), [F.asc("v")]).count() == 0
