import pytest

from postlens import schemas
from postlens.operators import hydrate as h
from postlens.plans.hydration import run_hydration
from postlens.session import scratch_path


def annotations(spark, *rows):
    data = [(i, None, bias, None, None, None, None, c, e, None, None, None, None, None) for i, bias, c, e in rows]
    return spark.createDataFrame(data, schemas.ANNOTATION)


def submissions(spark, *rows):
    names = [f.name for f in spark.createDataFrame([], schemas.SUBMISSION).schema.fields]
    data = [tuple(row.get(n) for n in names) + (row.get("at", 0),) for row in rows]
    return spark.createDataFrame(data, schemas.SUBMISSION + ", at INT")


WANTED = [("a", 1, 1, None), ("b", None, 0, 1), ("c", 0, 1, 1), ("d", 0, 0, 0), ("e", 0, 0, 0)]
BODIES = [
    {"id": "a", "title": "old", "selftext": "x", "at": 1},
    {"id": "a", "title": " new ", "selftext": "", "author": "", "full_link": "/f", "permalink": "", "at": 2},
    {"id": "b", "title": "t", "selftext": " body\n", "author": "ann", "score": 3, "is_self": False, "permalink": "/p"},
    {"id": "d", "title": " ", "selftext": ""},
    {"id": "z", "title": "not asked for"},
]


def test_posts_and_defaults(spark):
    posts = h.hydrate(annotations(spark, *WANTED), h.last_by_id(submissions(spark, *BODIES), "at"), "forum", "set")
    got = {r["id"]: r for r in posts.collect()}
    assert set(got) == {"a", "b"} and len(posts.columns) == 28
    a, b = got["a"], got["b"]
    assert (a["text"], a["title"], a["author"], a["permalink"], a["is_self"]) == ("new", " new ", "[deleted]", "/f", True)
    assert (a["score"], a["num_comments"], a["created_utc"]) == (0, 0, 0)
    assert (b["text"], b["author"], b["score"], b["is_self"], b["permalink"]) == ("t\n body", "ann", 3, False, "/p")
    assert (a["humanitarian_labels"], b["humanitarian_labels"]) == (["Casualty"], ["Evacuation"])
    assert (a["linguistic_bias"], b["linguistic_bias"], a["Advice"]) == (True, False, False)
    assert {r["dataset"] for r in got.values()} == {"set"}


def test_a_hot_id_keeps_its_last_row(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', string(id)) AS id", "id AS at", "concat('t', id) AS title")
    last = {r["id"]: r["title"] for r in h.last_by_id(rows, "at").collect()}
    assert last["hot"] == "t2997" and len(last) == 2001


def test_duplicate_annotations_fail(spark):
    with pytest.raises(ValueError, match="more than once"):
        h.require_unique(annotations(spark, WANTED[0], WANTED[0]))
    assert h.require_unique(annotations(spark, *WANTED)).count() == 5


def test_missing_and_unsaved(spark):
    wanted, bodies = annotations(spark, *WANTED), submissions(spark, *BODIES)
    assert sorted(r["id"] for r in h.missing_ids(wanted, bodies).collect()) == ["c", "e"]
    saved = spark.createDataFrame([("a",), ("q",), ("a",)], "id STRING")
    assert sorted(r["id"] for r in h.unsaved(wanted, saved).select("id").collect()) == ["b", "c", "d", "e"]


def test_stats_of_a_first_and_of_a_resumed_run(spark):
    wanted, bodies = annotations(spark, *WANTED), h.last_by_id(submissions(spark, *BODIES), "at")
    assert tuple(h.hydration_stats(wanted, bodies).first()) == (5, 2, 3)
    saved = spark.createDataFrame([("a",), ("q",)], "id STRING")
    assert tuple(h.hydration_stats(wanted, bodies, saved).first()) == (5, 3, 3)


def test_resumed_job_appends_each_post_once(spark):
    out = scratch_path(spark, "hydration")
    bodies = submissions(spark, *BODIES)
    wanted = annotations(spark, *WANTED)
    first = run_hydration(wanted, bodies, out, "forum", "set", order_col="at", resume=True, limit=1)
    assert (first["annotation_rows"], first["hydrated_posts"], first["missing_or_empty"]) == (1, 1, 0)
    for _ in range(2):
        again = run_hydration(wanted, bodies, out, "forum", "set", order_col="at", resume=True)
        assert (again["annotation_rows"], again["hydrated_posts"], again["missing_or_empty"]) == (5, 2, 3)
        assert sorted(r["id"] for r in spark.read.json(f"{out}/posts").collect()) == ["a", "b"]
    fresh = run_hydration(wanted, bodies, out, "forum", "set", order_col="at")
    assert fresh["hydrated_posts"] == 2 and spark.read.json(f"{out}/posts").count() == 2
