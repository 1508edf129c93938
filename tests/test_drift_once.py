"""Fields over time on planted rows; batches that take effect once."""

from __future__ import annotations

import pytest

from rowtide import batch_folder, field_drift, finished_batches, first_of_each, once_per_batch, written_once


def test_fields_that_come_go_and_widen(spark):
    rows = [
        ("a", 1, '{"k": 1, "x": 1, "old": true}'),
        ("a", 2, '{"k": 2, "x": 2.5, "odd.name\'s": null}'),
        ("a", 3, '{"k": 3, "x": 7, "n": {"m": 1}}'),
        ("a", 4, '{"k": 4, "x": null, "n": {"m": "w"}}'),
        ("a", 9, "[1, 2]"),
        ("a", 10, "{broken"),
        ("a", 11, None),
        (None, 5, '{"k": "t"}'),
        ("empty", 6, "{}"),
    ]
    log = spark.createDataFrame(rows, "tb string, seq int, text string")
    got = {(r.tb, r.field): tuple(r)[2:] for r in field_drift(log, ["tb"], "text", "seq").collect()}
    widened = got.pop(("a", "x"))
    assert widened[0].startswith("DECIMAL") and widened[1:] == (1, 4, 4, False, False)
    assert got == {
        ("a", "k"): ("BIGINT", 1, 4, 4, False, False),
        ("a", "old"): ("BOOLEAN", 1, 1, 1, False, True),
        ("a", "odd.name's"): ("VOID", 2, 2, 1, True, True),
        ("a", "n"): ("OBJECT<m: VARIANT>", 3, 4, 2, True, False),
        (None, "k"): ("STRING", 5, 5, 1, False, False),
    }
    assert field_drift(log, [], "text", "seq").where("field = 'k'").first()["type"] == "VARIANT"
    assert field_drift(log.limit(0), ["tb"], "text", "seq").isEmpty()
    with pytest.raises(ValueError):
        field_drift(log.withColumnRenamed("tb", "type"), ["type"], "text", "seq")


def test_a_finished_batch_is_not_written_again(spark, tmp_path):
    folder, tries = str(tmp_path), []
    store = batch_folder(f"{folder}/out")

    def write(batch, number):
        tries.append(number)
        store(batch, number)
        if tries == [0]:
            raise RuntimeError("lost after the write")

    apply = once_per_batch(folder, "out", write)
    df = spark.range(5)
    with pytest.raises(RuntimeError):
        apply(df, 0)
    for number in (0, 0, 1, 0, 1):
        apply(df, number)
    store(df, 2)  # written, never finished
    assert tries == [0, 0, 1]
    assert sorted(r.batch for r in finished_batches(spark, folder, "out").collect()) == [0, 1]
    rows = written_once(spark, folder, "out", f"{folder}/out", "id BIGINT").collect()
    assert sorted(r.id for r in rows) == sorted([*range(5)] * 2)


def test_first_of_each_in_a_table(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (1, 1), (None, 1), (None, 1)], "partition int, offset int")
    assert first_of_each(df, ["partition", "offset"], "time", "1 hour").count() == 3
