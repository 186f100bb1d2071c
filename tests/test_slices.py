"""Of a batch of texts or pages only a slice at a time is held as Python objects."""

import gc

import pyarrow as pa

from brightledger.functions import text as T
from brightledger.operators import reports


class Held:
    """A value that counts how many of its kind live."""

    alive = most = 0

    def __init__(self):
        Held.alive += 1
        Held.most = max(Held.most, Held.alive)

    def __del__(self):
        Held.alive -= 1


def test_a_batch_is_taken_by_slices():
    gc.collect()
    held = []

    def one(v):
        if len(held) == T.SLICE:
            held.clear()
        held.append(Held())
        return v

    values = pa.array([*range(1050), None])
    assert T.by_slices(values, one, pa.int64()).equals(values) and Held.most <= T.SLICE
    assert T.by_slices(pa.array([], pa.int64()), one, pa.int64()).equals(pa.array([], pa.int64()))


def test_positions_and_pages_come_of_arrow(spark):
    df = spark.range(250).selectExpr("if(id = 7, null, repeat('The x ', cast(id % 3 as int))) AS t", "if(id = 7, null, encode('é', 'UTF-8')) AS c")
    made = df.select(T.term_positions("t", {"the": "EN"}).alias("p"), reports.decoded("c", ("ascii", "utf-8")).alias("d"))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    rows = made.collect()
    assert rows[7].p is None and rows[7].d is None and {r.d for i, r in enumerate(rows) if i != 7} == {"é"}
    assert [(x.label, x.original, x.position, x.length) for x in rows[5].p] == [("EN", "The", 0, 3), ("EN", "The", 6, 3)] and rows[6].p == []
    assert "ArrowEvalPython" in plan
