"""Ten tables of the serving copy change together, whatever stops and however publishes interleave."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from ledgerline.contracts import GOLD
from ledgerline.operators import serving as V
from ledgerline.sources import files

D1, D2, D3 = (dt.date(2024, 3, d) for d in (1, 2, 3))


def regions(spark, *names):
    return spark.createDataFrame([(k, n, "c") for k, n in enumerate(names)], GOLD["dim_region"])


def payments(spark, *rows):
    base = spark.createDataFrame([(i, d) for i, d in rows], "payment_id string, batch_date date")
    return base.select(*[F.col(f.name) if f.name in base.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in GOLD["fact_payments"].fields])


def publish(spark, root, name, rows, days, commit=True):
    run = V.Publish(spark, root)
    run.dimension("dim_region", regions(spark, name))
    run.fact("fact_payments", payments(spark, *rows), days)
    return run.commit() if commit else run


def seen(spark, root):
    dim = [r.region for r in V.read(spark, root, "dim_region").collect()]
    return dim, sorted((r.payment_id, r.batch_date) for r in V.read(spark, root, "fact_payments").collect())


def test_days_are_replaced_and_emptied(spark, workdir):
    publish(spark, workdir, "one", [("a", D1), ("b", D2)], [D1, D2])
    assert seen(spark, workdir) == (["one"], [("a", D1), ("b", D2)])
    publish(spark, workdir, "two", [("c", D1), ("x", D3)], [D1])  # rows of other days aren't the run's
    assert seen(spark, workdir) == (["two"], [("b", D2), ("c", D1)])
    publish(spark, workdir, "three", [], [D2])
    assert seen(spark, workdir) == (["three"], [("c", D1)])
    assert V.read(spark, workdir, "fact_payments").schema == GOLD["fact_payments"]
    assert V.read(spark, workdir, "fact_payments", [D2]).count() == 0 and V.read(spark, workdir, "fact_payments", [D1]).count() == 1
    publish(spark, workdir, "four", [("d", D2)], [D2])
    assert {f.split("/batch_date=")[1][:10] for f in V.read(spark, workdir, "fact_payments", [D1]).inputFiles()} == {"2024-03-01"}


def test_nothing_is_seen_before_the_pointer(spark, workdir):
    before = publish(spark, workdir, "one", [("a", D1)], [D1])
    run = publish(spark, workdir, "two", [("b", D1)], [D1], commit=False)
    assert seen(spark, workdir) == (["one"], [("a", D1)])
    assert len(V.orphans(spark, workdir)) == 2 and all(run.run in f for f in V.orphans(spark, workdir))
    run.commit()
    assert seen(spark, workdir) == (["two"], [("b", D1)])
    held = V.read(spark, workdir, "dim_region", pointer=before).collect(), V.read(spark, workdir, "fact_payments", pointer=before).collect()
    assert held[0][0].region == "one" and held[1][0].payment_id == "a", "a reader keeps the publish it began with"


@pytest.mark.parametrize("step", ["dimension", "fact", "create"])
def test_a_stop_leaves_all_as_before(spark, workdir, monkeypatch, step):
    publish(spark, workdir, "one", [("a", D1)], [D1])
    stop = lambda *a, **k: (_ for _ in ()).throw(OSError("stopped"))
    if step == "create":
        monkeypatch.setattr(files, "create_text", stop)
    else:
        monkeypatch.setattr(V.Publish, step, stop)
    with pytest.raises(OSError, match="stopped"):
        publish(spark, workdir, "two", [("b", D1)], [D1])
    monkeypatch.undo()
    assert seen(spark, workdir) == (["one"], [("a", D1)])
    publish(spark, workdir, "two", [("b", D1)], [D1])
    assert seen(spark, workdir) == (["two"], [("b", D1)])


def test_a_stop_after_the_pointer_leaves_all_as_after(spark, workdir, monkeypatch):
    publish(spark, workdir, "one", [("a", D1)], [D1])
    monkeypatch.setattr(V, "_clean", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError, match="stopped"):
        publish(spark, workdir, "two", [("b", D1)], [D1])
    monkeypatch.undo()
    assert seen(spark, workdir) == (["two"], [("b", D1)])


def test_interleaved_publishes_both_end_whole(spark, workdir):
    first = publish(spark, workdir, "first", [("a", D1)], [D1], commit=False)
    second = publish(spark, workdir, "second", [("b", D2)], [D2], commit=False)
    second.commit()
    first.commit()
    assert seen(spark, workdir) == (["first"], [("a", D1), ("b", D2)])


def test_a_table_by_key_is_merged_again_after_another_publish(spark, workdir):
    dates = lambda *days: spark.createDataFrame([(d,) for d in days], "date_key int").select(
        *[F.col(f.name) if f.name == "date_key" else F.lit(None).cast(f.dataType).alias(f.name) for f in GOLD["dim_date"].fields])
    runs = [V.Publish(spark, workdir) for _ in range(3)]
    for k, run in enumerate(runs):
        run.keyed("dim_date", dates(1, 10 + k), ["date_key"])
    for run in runs:
        run.commit()
    assert sorted(r.date_key for r in V.read(spark, workdir, "dim_date").collect()) == [1, 10, 11, 12]
    V.Publish(spark, workdir).commit()
    assert V.read(spark, workdir, "dim_date").count() == 4 and not V.orphans(spark, workdir)


def test_publishes_that_take_the_same_number(spark, workdir):
    runs = [publish(spark, workdir, f"r{k}", [(f"p{k}", dt.date(2024, 4, k + 1))], [dt.date(2024, 4, k + 1)], commit=False) for k in range(4)]
    current = V.read_pointer(spark, workdir)
    gate = threading.Barrier(4)
    read = V.read_pointer

    def together(*args, **options):
        pointer = read(*args, **options)
        if pointer.number == current.number and len(args) == 2:
            gate.wait(30)
        return pointer

    V.read_pointer = together
    try:
        threads = [threading.Thread(target=r.commit) for r in runs]
        [t.start() for t in threads]
        [t.join(120) for t in threads]
    finally:
        V.read_pointer = read
    assert V.numbers(spark, workdir) == [1, 2, 3, 4]
    assert [p for p, _ in seen(spark, workdir)[1]] == ["p0", "p1", "p2", "p3"]
    assert not [f for f in os.listdir(f"{workdir}/_pointers") if f.startswith("_") and not f.endswith(".crc")]


def test_old_folders_go_with_their_pointers(spark, workdir, monkeypatch):
    monkeypatch.setattr(V, "KEEP", 2)
    for k in range(5):
        publish(spark, workdir, f"r{k}", [(f"a{k}", D1)] + ([("kept", D2)] if k == 0 else []), [D1, D2] if k == 0 else [D1])
    assert V.numbers(spark, workdir) == [4, 5]
    assert len([f for f in os.listdir(f"{workdir}/gold/dim_region") if f.startswith("run=")]) == 2
    assert len([f for f in os.listdir(f"{workdir}/gold/fact_payments/batch_date=2024-03-01") if f.startswith("run=")]) == 2
    assert seen(spark, workdir) == (["r4"], [("a4", D1), ("kept", D2)]) and not V.orphans(spark, workdir)


def test_before_the_first_publish(spark, workdir):
    assert V.read_pointer(spark, workdir).number == 0 and V.numbers(spark, workdir) == []
    assert V.read(spark, workdir, "fact_payments").count() == 0
