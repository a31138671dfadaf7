"""The whole run (B8): load, replace-all, failures that leave the old tables, rebuild from raw."""
import os

import pytest

from starforge.operators.quality import EmptyInputError, ValidationError
from starforge.plans import reports
from starforge.plans import run as run_module
from starforge.plans.run import run, summary
from starforge.sources import store
from starforge.sources.store import read_tables
from tests.conftest import HEADER, line

STAMP = "2024-01-01 08:00:00"


def _write(tmp_path, name, rows):
    d = tmp_path / name
    d.mkdir()
    (d / "jobs.csv").write_text(HEADER + "\n" + "\n".join(rows) + "\n", encoding="utf-8")
    return str(d)


def folders(out):
    return sorted(n for n in os.listdir(out) if not n.startswith(("_tables-", "._tables-", ".")))


def rows_of(spark, out):
    return {r.tabla: r.filas for r in reports.load_counts(read_tables(spark, out)).collect()}


@pytest.fixture
def loaded(spark, tmp_path):
    out = str(tmp_path / "wh")
    rows = [line(), line(job_title_short="Cloud Engineer", company_name="Duna SA", job_skills="['rust', 'go']"),
            '"broken,line"']
    counts = run(spark, _write(tmp_path, "first", rows), out, now=STAMP)
    return out, counts


def test_counts_and_summary(loaded):
    _, counts = loaded
    assert counts == {"dim_companies": 2, "dim_locations": 1, "dim_skills": 2, "fact_jobs": 2, "bridge_job_skills": 3,
                      "raw_jobs": 2, "raw_jobs_rejected": 1}
    assert "fact_jobs: 2" in summary(counts)


def test_validation_failure_is_readable_and_changes_nothing(spark, tmp_path, loaded, caplog):
    out, _ = loaded
    before = folders(out)
    bad = [line(job_title_short="Lighthouse Keeper"), line(salary_year_avg="-1")]
    with caplog.at_level("ERROR", "starforge"), pytest.raises(ValidationError) as e:
        run(spark, _write(tmp_path, "bad", bad), out)
    got = sorted((r["raw_id"], r["column"], r["failure_case"]) for r in e.value.failures.collect())
    assert got == [(1, "job_title_short", "Lighthouse Keeper"), (2, "salary_year_avg", "-1.0")]
    assert "2 data-quality failures" in caplog.text and "Lighthouse Keeper" in caplog.text
    assert folders(out) == sorted([*before, "_validation_failures"]) and rows_of(spark, out)["fact_jobs"] == 2


def test_all_rejected_publishes_the_rejects(spark, tmp_path, loaded):
    out, _ = loaded
    with pytest.raises(EmptyInputError):
        run(spark, _write(tmp_path, "junk", ['"one"', '"two,three"', '"four"']), out)
    rows = rows_of(spark, out)
    assert (rows["raw_jobs"], rows["raw_jobs_rejected"], rows["fact_jobs"]) == (0, 3, 2)


def test_failure_while_building_leaves_nothing(spark, tmp_path, loaded, monkeypatch):
    out, _ = loaded
    before = folders(out)

    def fail(*a, **k):
        raise RuntimeError("no star today")
    monkeypatch.setattr(run_module, "build_star", fail)
    with pytest.raises(RuntimeError):
        run(spark, _write(tmp_path, "second", [line()]), out)
    assert folders(out) == before and rows_of(spark, out)["raw_jobs"] == 2


def test_failure_while_publishing_shows_the_old_set(spark, tmp_path, loaded, monkeypatch):
    out, _ = loaded
    saved, done = store.save_table, []

    def fail_at_third(*a, **k):
        if len(done) == 2:
            raise OSError("disk full")
        done.append(1)
        return saved(*a, **k)
    monkeypatch.setattr(store, "save_table", fail_at_third)
    with pytest.raises(OSError):
        run(spark, _write(tmp_path, "second", [line()] * 5), out)
    monkeypatch.undo()
    assert rows_of(spark, out)["fact_jobs"] == 2 == rows_of(spark, out)["raw_jobs"]


def test_loads_replace_and_old_runs_go(spark, tmp_path, loaded):
    out, _ = loaded
    for n in (1, 3, 4, 5):
        counts = run(spark, _write(tmp_path, f"in{n}", [line()] * n), out, now=STAMP)
        assert counts["fact_jobs"] == n == rows_of(spark, out)["raw_jobs"]
    assert len(folders(out)) == 2


def test_rebuild_from_the_raw_table(spark, loaded):
    out, _ = loaded
    again = run(spark, None, out, load_raw=False)
    assert again["fact_jobs"] == 2 and "raw_jobs" not in again
    t = read_tables(spark, out)
    assert reports.valid_share(t).first().porcentaje_calidad == "66.67%"
    assert reports.ads_for_skill(t, "rust").first()["count"] == 2


def test_command_line(spark, tmp_path):
    from starforge.__main__ import main
    out = str(tmp_path / "wh")
    counts = main(["--csv", _write(tmp_path, "in", [line(), '"broken"']), "--out", out])
    assert counts["fact_jobs"] == 1 and counts["raw_jobs_rejected"] == 1
    assert main(["--out", out, "--skip-raw"])["fact_jobs"] == 1
