"""Publishing table sets (L1, L5): several runs at a time, unfinished manifests, and written schemas (L2, L3)."""
import os
import threading

import pytest

from starforge.sources import store
from starforge.sources.store import publish, published, save_tables


def folder(out, run, table):
    path = os.path.join(out, run, table)
    os.makedirs(path, exist_ok=True)
    return path


def test_a_late_publisher_retries_on_top_of_the_other(spark, tmp_path, monkeypatch):
    """Two runs see the same newest manifest; the second finds its number taken and keeps the first one's tables."""
    out = str(tmp_path)
    publish(spark, out, {"a": folder(out, "run-0", "a"), "b": folder(out, "run-0", "b")})
    seen = store._newest(spark, out)
    assert publish(spark, out, {"a": folder(out, "run-1", "a")}) == 2
    real, calls = store._newest, []

    def first_stale(*args):
        calls.append(1)
        return seen if len(calls) == 1 else real(*args)
    monkeypatch.setattr(store, "_newest", first_stale)
    assert publish(spark, out, {"b": folder(out, "run-2", "b")}) == 3 and len(calls) == 2
    assert published(spark, out) == {"a": f"{out}/run-1/a", "b": f"{out}/run-2/b"}
    assert sorted(n for n in os.listdir(out) if not n.startswith(".")) == [
        "_tables-00000002", "_tables-00000003", "run-0", "run-1", "run-2"]     # 2 still names run-0's b


def test_many_publishers_at_once(spark, tmp_path):
    out, failed = str(tmp_path), []
    start = threading.Barrier(6)

    def one(k):
        try:
            start.wait()
            for step in range(3):
                publish(spark, out, {f"t{k}": folder(out, f"run-{k}-{step}", f"t{k}")})
        except Exception as e:  # noqa: BLE001
            failed.append(e)
    threads = [threading.Thread(target=one, args=(k,)) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert published(spark, out) == {f"t{k}": f"{out}/run-{k}-2/t{k}" for k in range(6)}
    assert store._manifests(spark, out)[-1][0] == 18


def test_folders_of_runs_that_are_not_published_yet_stay(spark, tmp_path):
    out = str(tmp_path)
    folder(out, "run-busy", "a")
    for k in range(5):
        publish(spark, out, {"a": folder(out, f"run-{k}", "a")})
    assert sorted(n for n in os.listdir(out) if n.startswith("run-")) == ["run-3", "run-4", "run-busy"]


@pytest.mark.parametrize("text", ["", '{"a": "run'])
def test_an_unfinished_manifest_is_passed_over(spark, tmp_path, text):
    out = str(tmp_path)
    publish(spark, out, {"a": folder(out, "run-1", "a")})
    (tmp_path / "_tables-00000002").write_text(text)
    assert published(spark, out) == {"a": f"{out}/run-1/a"}
    assert publish(spark, out, {"b": folder(out, "run-3", "b")}) == 3
    assert published(spark, out) == {"a": f"{out}/run-1/a", "b": f"{out}/run-3/b"}


def test_other_errors_are_raised(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    with pytest.raises(Exception):
        publish(spark, str(tmp_path / "file"), {"a": str(tmp_path / "file" / "run-1" / "a")})


def test_two_loads_at_once_are_both_whole(spark, tmp_path):
    """Tables of one load are never mixed with those of another that publishes all of them."""
    out, counts = str(tmp_path / "wh"), {}

    def load(n):
        df = spark.range(n).selectExpr("id AS company_id", "'x' AS company_name")
        counts[n] = save_tables(spark, {"dim_companies": df, "extra": df}, out)
    threads = [threading.Thread(target=load, args=(n,)) for n in (3, 8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert counts == {n: {"dim_companies": n, "extra": n} for n in (3, 8)}
    now = store.read_tables(spark, out, ["dim_companies", "extra"])
    assert now["dim_companies"].count() == now["extra"].count()
