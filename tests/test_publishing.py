import pytest
from pyspark.sql import functions as F

from tripleloom.functions import terms as t
from tripleloom.operators import publishing
from tripleloom.sources.constants import constant_triples

ROWS = [("http://x/s", "http://x/p", w, "lit", "", "en") for w in ("a", "é", "line\nend")]


def test_versions_dates_rows_and_bytes(spark, tmp_path):
    folder, table = str(tmp_path / "out"), constant_triples(spark, ROWS)
    one = publishing.publish(spark, {"a": table, "empty": table.limit(0)}, folder, "2026-01-01").collect()
    assert {(r["version"], r["g"], r["triples"], r["created"], r["modified"]) for r in one} == {
        (1, "a", 3, "2026-01-01", "2026-01-01"), (1, "empty", 0, "2026-01-01", "2026-01-01")}
    written = {r["g"]: r["bytes"] for r in one}
    lines = [f'<http://x/s> <http://x/p> "{w}"@en .\n' for w in ("a", "é", "line\\nend")]
    assert written == {"a": sum(len(x.encode()) for x in lines), "empty": 0}
    two = publishing.publish(spark, {"a": table.limit(1), "b": table}, folder, "2026-02-02").collect()
    assert {(r["version"], r["g"], r["triples"], r["created"], r["modified"]) for r in two} == {
        (2, "a", 1, "2026-01-01", "2026-02-02"), (2, "b", 3, "2026-02-02", "2026-02-02")}
    assert publishing.manifest(spark, folder).count() == 4
    read = publishing.read_published(spark, folder)
    assert {tuple(r) for r in read.groupBy("g").count().collect()} == {("a", 1), ("b", 3)}
    assert sorted(tuple(r) for r in read.where("g = 'b'").select(*t.TERM).collect()) == sorted(ROWS)


def test_a_failed_publish_changes_nothing(spark, tmp_path):
    folder, table = str(tmp_path / "out"), constant_triples(spark, ROWS)
    publishing.publish(spark, {"a": table}, folder, "2026-01-01")
    broken = table.withColumn("o", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        publishing.publish(spark, {"a": table.limit(1), "b": broken}, folder, "2026-02-02")
    assert publishing.manifest(spark, folder).count() == 1
    assert publishing.read_published(spark, folder).count() == 3


def test_published_files_are_stored_compressed(spark, tmp_path):
    rows = [(f"http://x/s{i}", "http://x/p", "o", "lit", "", "en") for i in range(20000)]
    one = publishing.publish(spark, {"a": constant_triples(spark, rows)}, str(tmp_path / "out"), "2026-01-01").first()
    assert one["bytes"] == sum(len(f'<{s}> <{p}> "{o}"@en .\n') for s, p, o, *_ in rows)
    assert one["stored_bytes"] * 5 < one["bytes"]
    assert sorted(tuple(r) for r in publishing.read_published(spark, str(tmp_path / "out")).select(*t.TERM).collect()) == sorted(rows)
