"""A ledger of stream sums: late rows aside, replays without effect, all rows accounted for."""
import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridspark.operators import bias as B
from gridspark.streaming import departures as SD
from gridspark.streaming import ledger as SL

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id int, obs_time timestamp, channel int, ombg double, err0 double, qc0 int, p0 double, p1 double, obs double, hofx double, bias double"


def batches():
    rnd = random.Random(4)
    made = []
    for k in range(4):
        hours = [24 * k + rnd.random() * 24 for _ in range(60)]
        if k:
            hours += [24 * (k - 1) + rnd.random() * 24 for _ in range(15)]  # from the delivery before
        made.append([(1000 * k + n, T0 + dt.timedelta(hours=h), n % 2, rnd.gauss(0, 1) if n % 9 else None, 1.0 + n % 3, n % 3, 1.0, rnd.random(), rnd.random(), rnd.random(), 0.1) for n, h in enumerate(hours)])
    made[2].append((9999, None, 0, 1.0, 1.0, 0, 1.0, 1.0, 1.0, 1.0, 1.0))
    return made


def judged(made):
    """(batch, cycle, late) of every row by the rule itself."""
    out, largest = {}, None
    for k, part in enumerate(made):
        mark = None if largest is None else largest - dt.timedelta(hours=3)
        for r in part:
            if r[1] is None:
                out[r[0]] = (k, None, True)
                continue
            c = T0 + dt.timedelta(hours=6 * (((r[1] - T0).total_seconds() / 3600 + 3) // 6))
            out[r[0]] = (k, c, mark is not None and c + dt.timedelta(hours=3) <= mark)
        largest = max([largest or T0, *(r[1] for r in part if r[1])])
    return out, largest


def test_emitted_and_late_rows_are_all_rows(spark, tmp_path):
    made = batches()
    want, largest = judged(made)
    ledger = SL.Ledger(spark, str(tmp_path / "l"), ["channel"], [F.count(F.lit(1)).alias("n_rows"), *SL.departure_sums()])
    for k, part in enumerate(made):
        ledger.add(spark.createDataFrame(part, SCHEMA).repartition(3), k)
    late = {r["id"]: (r["batch"], r["cycle"]) for r in ledger.late().collect()}
    assert late == {i: (k, c) for i, (k, c, x) in want.items() if x} and len(late) >= 20
    total = ledger.sums(open_cycles=True)
    assert total.agg(F.sum("n_rows")).first()[0] + len(late) == sum(map(len, made))
    kept = spark.createDataFrame([r for part in made for r in part if r[0] not in late and r[1]], SCHEMA)
    batch = SD._labelled(kept.groupBy(SD.cycle_window(), "channel").agg(F.count(F.lit(1)).alias("n_rows"), F.avg(F.when(F.col("qc0") <= 1, F.col("ombg"))).alias("omb_mean")))
    mine = {(r["cycle"], r["channel"]): r["omb_mean"] for r in SL.departures(total, ["channel"]).collect()}
    theirs = {(r["cycle"], r["channel"]): r["omb_mean"] for r in batch.collect()}
    assert mine.keys() == theirs.keys() and all(mine[k] == pytest.approx(theirs[k]) for k in mine)
    closed = {r["cycle"] for r in ledger.sums().select("cycle").distinct().collect()}
    assert closed == {c for _, c, x in want.values() if c and not x and c + dt.timedelta(hours=6) <= largest}
    # a batch that runs again, also with rows in another order, adds nothing
    before = rows(total)
    for k in (1, 3, 3):
        ledger.add(spark.createDataFrame(made[k][::-1], SCHEMA), k)
    again = rows(ledger.sums(open_cycles=True))
    assert [[round(x, 9) if isinstance(x, float) else x for x in r] for r in again] == [[round(x, 9) if isinstance(x, float) else x for x in r] for r in before]
    assert ledger.late().count() == len(late)


def test_a_batch_that_stopped_half_way_is_not_counted(spark, tmp_path, monkeypatch):
    made = batches()
    ledger = SL.normal_ledger(spark, str(tmp_path / "l"), ["p0", "p1"], ["channel"], spark.createDataFrame(made[0], SCHEMA))
    ledger.add(spark.createDataFrame(made[0], SCHEMA), 0)
    before = ledger.sums(open_cycles=True).agg(F.sum("n_obs")).first()[0]
    own = ledger._write

    def stop(part, rows_, batch_id):
        if part == "marks":
            raise KeyboardInterrupt
        own(part, rows_, batch_id)

    monkeypatch.setattr(ledger, "_write", stop)
    with pytest.raises(KeyboardInterrupt):
        ledger.add(spark.createDataFrame(made[1], SCHEMA), 1)
    assert ledger.sums(open_cycles=True).agg(F.sum("n_obs")).first()[0] == before
    monkeypatch.undo()
    got = []
    SL.each_batch(ledger, lambda sums, batch_id: got.append((batch_id, sums.count())))(spark.createDataFrame(made[1], SCHEMA), 1)
    assert got[0][0] == 1 and got[0][1] > 0
    every = spark.createDataFrame([r for part in made[:2] for r in part], SCHEMA).withColumn("cycle", SD.cycle_window()["start"] + F.expr("INTERVAL 3 HOURS"))
    late = ledger.late().select("id")
    want = B.solve_bias(B.normal_sums(every.join(late, "id", "left_anti"), ["p0", "p1"], ["cycle", "channel"]), ["p0", "p1"], ["cycle", "channel"])
    mine = {(r["cycle"], r["channel"], r["predictor"]): r["beta"] for r in SL.coefficients(ledger.sums(), ["p0", "p1"], ["channel"]).collect()}
    theirs = {(r["cycle"], r["channel"], r["predictor"]): r["beta"] for r in want.collect()}
    assert len(mine) >= 10 and all(theirs[k] == pytest.approx(v) for k, v in mine.items())
