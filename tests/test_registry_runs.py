"""Runs that are stopped, go on, follow one another and take over older caches."""

import csv

import pytest
from pyspark.sql import functions as F
from test_operators import TEXT, one

from gridloom import cli
from gridloom.functions import text as T
from gridloom.params import RegistryParams
from gridloom.plans import registry


def folder(tmp_path, n=7):
    root = tmp_path / "docs"
    root.mkdir()
    for i in range(n):
        (root / f"{i}.txt").write_text(TEXT.format(kind="Помещение", address=f"ул. {i}, кв. {i}"), encoding="utf-8")
    return root


def worklist(tmp_path, name, paths):
    (tmp_path / name).write_text("путь\n" + "\n".join(paths) + "\n", encoding="utf-8")
    return str(tmp_path / name)


def rows(path):
    return [r for f in sorted(path.glob("part-*.csv")) for r in csv.DictReader(f.open(encoding="utf-8-sig"))]


def test_a_stopped_run_reports_and_goes_on(spark, tmp_path, monkeypatch):
    root, results = folder(tmp_path), str(tmp_path / "results")
    work = worklist(tmp_path, "w.csv", [f"{i}.txt" for i in range(7)])
    go = lambda: registry.run_and_report(spark, work, str(root), results, str(tmp_path / "out"), str(tmp_path / "skipped"), RegistryParams(portion=2))
    append, calls = registry.append_results, []

    def stopped(records, path):
        if len(calls) == 2:
            raise KeyboardInterrupt
        calls.append(path)
        append(records, path)

    monkeypatch.setattr(registry, "append_results", stopped)
    with pytest.raises(KeyboardInterrupt):
        go()
    assert {r["файл"] for r in rows(tmp_path / "out")} == {f"{i}.txt" for i in range(4)}
    monkeypatch.undo()
    assert {r.status: r.n for r in go().collect()} == {"success": 7}
    found = {r["файл"]: int(r["№ п/п"]) for r in rows(tmp_path / "out")}
    assert found == {f"{i}.txt": i + 1 for i in range(7)}
    assert {(r.run, r.portion): r["count"] for r in spark.read.parquet(results).groupBy("run", "portion").count().collect()} == {(1, 0): 2, (1, 1): 2, (2, 0): 2, (2, 1): 1}


def test_the_first_run_is_numbered_first(spark, tmp_path):
    root, results = folder(tmp_path), str(tmp_path / "results")
    for name, paths in (("b.csv", ["5.txt", "6.txt", "4.txt"]), ("a.csv", ["1.txt", "5.txt", "0.txt"])):
        registry.run_registry(spark, worklist(tmp_path, name, paths), str(root), results)
    report, _ = registry.reports(spark.read.parquet(results))
    assert [r["файл"] for r in report.orderBy("№ п/п").collect()] == ["5.txt", "6.txt", "4.txt", "1.txt", "0.txt"]


def test_older_caches_are_taken_over(spark, tmp_path):
    root = folder(tmp_path, 3)
    caches = tmp_path / "caches"
    caches.mkdir()
    head = ["путь", *registry.CACHE_HEADINGS.values()]
    with (caches / "x_success_cache.csv").open("w", encoding="utf-8-sig", newline="") as f:
        w = csv.DictWriter(f, head)
        w.writeheader()
        w.writerow(dict.fromkeys(head, "") | {"путь": "old.pdf", "адрес": 'ул. "Я", 1', "кадастровый номер": "1:1"})
    (caches / "x_skipped_cache.csv").write_text("файл,причина\n1.txt,так\n", encoding="utf-8")
    (caches / "x_errors_cache.csv").write_text("файл,ошибка\nbad.pdf,ошибка чтения: x\n", encoding="utf-8")
    (caches / "other.csv").write_text("файл\n0.txt\n", encoding="utf-8")
    work = worklist(tmp_path, "w.csv", ["0.txt", "1.txt", "old.pdf", "bad.pdf", "gone.txt"])
    args = ["registry", "--csv", work, "--root", str(root), "--results", str(tmp_path / "r"), "--cache-dir", str(caches), "--out", str(tmp_path / "out"), "--skipped-out", str(tmp_path / "sk")]
    for _ in range(2):
        assert cli.main(args) == 0
        found = {r["файл"]: (r["№ п/п"], r["Адрес помещения (ул, б-р, дом)"], r["ошибка"]) for r in rows(tmp_path / "out")}
        assert found == {"old.pdf": ("1", 'ул. "Я", 1', ""), "0.txt": ("2", "ул. 0", ""), "bad.pdf": ("", "", "ошибка чтения: x")}
        assert {(r["файл"], r["причина"]) for r in rows(tmp_path / "sk")} == {("1.txt", "так"), ("gone.txt", "файл не найден по пути из CSV")}


@pytest.mark.parametrize(("text", "want"), [("", []), (None, []), ("1", [("1", "1", 0)]), ("a1,5b", [("1,5", "1.5", 1)]), ("😀é 7,5 8.25.3 ٣", [("7,5", "7.5", 3), ("8.25", "8.25", 7), ("3", "3", 12), ("٣", "٣", 14)]), ("12 " * 300, [("12", "12", 3 * i) for i in range(300)])])
def test_number_places(spark, text, want):
    assert [tuple(x) for x in one(spark, T.number_candidates, text)] == want


def test_number_places_stay_in_the_jvm(spark):
    plan = spark.createDataFrame([("1",)], "s string").select(T.number_candidates(F.col("s")))._jdf.queryExecution().toString()
    assert "Python" not in plan
