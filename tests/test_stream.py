import json

from postlens.session import scratch_path
from postlens.streaming import capture

RECORDS = ['{"text": "Hurricane near"}', '{"text": "calm"}', "HURRICANE \"quoted\"", "irma", "", "hurricane é"]


def drop(spark, folder, lines, name):
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.txt", "w", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")


def values(frame):
    return sorted(r["value"] for r in frame.select("value").collect())


def run(spark, source, out, checkpoint, terms=("Hurricane",)):
    stream = capture.file_stream(spark, source, "value STRING", "text")
    capture.start_capture(stream, terms, out, checkpoint, available_now=True).awaitTermination()


def test_three_copies_and_no_record_twice(spark):
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    drop(spark, source, RECORDS, "one")
    run(spark, source, out, f"{out}-checkpoint")
    kept = sorted(r for r in RECORDS if "hurricane" in r.lower())
    assert values(capture.read_captured(spark, out)) == kept
    assert values(spark.read.text(f"{out}/{capture.LINES}")) == kept
    assert sorted(json.loads(v) for v in values(spark.read.text(f"{out}/{capture.QUOTED}"))) == kept

    run(spark, source, out, f"{out}-checkpoint")
    assert values(capture.read_captured(spark, out)) == kept
    drop(spark, source, ["another hurricane"], "two")
    run(spark, source, out, f"{out}-checkpoint")
    assert values(capture.read_captured(spark, out)) == sorted([*kept, "another hurricane"])


def test_a_batch_that_is_run_again_replaces_its_files(spark):
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    drop(spark, source, RECORDS, "one")
    run(spark, source, out, scratch_path(spark, "lost"))
    run(spark, source, out, scratch_path(spark, "new"))
    assert len(values(capture.read_captured(spark, out))) == 3


def test_case_sensitive_terms(spark):
    frame = spark.createDataFrame([(r,) for r in [*RECORDS, None]], "value STRING")
    assert frame.filter(capture.tracks(frame["value"], ["Hurricane"], case_sensitive=True)).count() == 1
    assert frame.filter(capture.tracks(frame["value"], ["hurricane", "irma"])).count() == 4


def test_new_posts_arrive_once(spark):
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for name, ids in (("one", [1, 2, 2]), ("two", [2, 3])):
        drop(spark, source, [json.dumps({"id": i}) for i in ids], name)
        stream = capture.file_stream(spark, source, "id BIGINT", "json")
        capture.start_new_posts(stream, f"{out}/posts", f"{out}/check", available_now=True).awaitTermination()
    assert sorted(r["id"] for r in spark.read.schema("id BIGINT").json(f"{out}/posts").collect()) == [1, 2, 3]


def test_a_table_is_a_stream_as_a_file_and_as_a_folder(spark, sf):
    from postlens.plans import catalog

    folder = scratch_path(spark, "tables").removeprefix("file:")
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    turns.repartition(3).write.parquet(f"{folder}/conversations.parquet")
    turns.limit(5).write.parquet(f"{folder}/conversations.parquet.old")
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(2).write.parquet(f"{folder}/many/events.parquet")
    expected = sorted(r[0] for r in turns.select("conv_id").distinct().collect())
    for place in (sf, folder):
        assert sorted(r["id"] for r in catalog.stream_new_posts(spark, place).collect()) == expected
    tracked = [sorted(catalog.stream_track(spark, place).collect()) for place in (sf, f"{folder}/many")]
    assert tracked[0] == tracked[1] and tracked[0]
