from pathlib import Path

import pytest
from pyspark.sql import functions as F

import qualitygate as qg
from qualitygate.operators import scoring
from qualitygate.plans import broadcasting
from qualitygate.spec import CHOICE, EVALUATION, NOUL, SCORE, DatasetSpec, Options, Question
from tests.conftest import rows

SPEC = DatasetSpec(
    name="notes", table="notes", text_columns=("note", "kind"), enum_column="kind", valid_values=("a", "b"),
    completeness_column="note",
    questions=(Question("good", NOUL), Question("kind", CHOICE), Question("depth", SCORE)),
    quality_weights={"good": 0.5, "kind": 0.2, "depth": 0.3},
)
EXPRESSION = qg.ExpressionEvaluator(
    {"good": "length(note) / 10.0D", "kind": "kind", "depth": "3.0D"},
    confidence={"kind": "0.5D"},
    tokens="1000",
)


@pytest.fixture
def notes(spark):
    def make(data):
        return spark.createDataFrame(data, "row_id string, deployment_version string, note string, kind string")

    return make


DATA = [
    ("1", "v1", "zzzz", "a"),
    ("1", "v1", "yy", "a"),
    ("1", "v1", None, "a"),
    ("1", "v2", "xxxxxx", "b"),
    ("2", "v1", "w", "b"),
    (None, "v1", "nn", "a"),
    (None, "v1", "nnn", "a"),
]


def quality(length):
    return round((0.5 * length / 10 + 0.2 * 0.5 + 0.3 * 0.5) / 1.0, 9)


def scores(evals):
    return [(i, v, round(q, 9)) for i, v, q in rows(evals, "row_id", "deployment_version", "quality")]


def test_first_of_equal_keys_is_shared_by_all_copies(notes):
    evals = qg.score(notes(DATA), SPEC, EXPRESSION)
    assert evals.schema.simpleString() == EVALUATION.simpleString()
    want = [("1", "v1", quality(2))] * 3 + [("1", "v2", quality(6)), ("2", "v1", quality(1))]
    assert scores(evals) == sorted(want + [(None, "v1", quality(2))] * 2, key=repr)
    assert rows(qg.distinct_keys(evals)) == [(4,)]
    once = qg.score(notes(DATA), SPEC, EXPRESSION, repeat_copies=False)
    assert len(scores(once)) == 4


def test_tie_break_column_decides(notes):
    df = notes([("1", "v1", "aaaa", "b"), ("1", "v1", "bb", "a")])
    assert scores(qg.score(df, SPEC, EXPRESSION, tie_break=["kind"], repeat_copies=False)) == [("1", "v1", quality(2))]
    assert scores(qg.score(df, SPEC, EXPRESSION, repeat_copies=False)) == [("1", "v1", quality(4))]


def test_many_repeated_keys_take_the_other_way(notes, monkeypatch):
    want = scores(qg.score(notes(DATA), SPEC, EXPRESSION))
    monkeypatch.setattr(scoring, "BROADCAST_ROWS", 0)
    assert scores(qg.score(notes(DATA), SPEC, EXPRESSION)) == want


def test_very_many_copies_are_dealt_out(spark, monkeypatch, many_partitions):
    df = spark.range(25_000).select(
        F.lit("h").alias("row_id"), F.lit("v").alias("deployment_version"), F.lit("nn").alias("note"), F.lit("a").alias("kind")
    )
    monkeypatch.setattr(scoring, "COPIES_PER_CHUNK", 1000)
    evals = qg.score(df, SPEC, EXPRESSION)
    assert evals.count() == 25_000
    dealt = scoring.per_input_row(
        qg.score_with_errors(df, SPEC, EXPRESSION), deal=True, chunk=1000
    ).groupBy(F.spark_partition_id()).count()
    assert len(dealt.collect()) > 1 and dealt.agg(F.max("count")).first()[0] < 25_000


@pytest.mark.parametrize("limit", [100_000, 3, 0])
def test_unscored(notes, monkeypatch, limit):
    monkeypatch.setattr(broadcasting, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(scoring, "BROADCAST_ROWS", limit)
    log = notes([("1", "v1", "x", "x")] * 5 + [(None, "v1", "x", "x"), ("9", "v9", "x", "x")])
    got = rows(qg.unscored(notes(DATA), log), "row_id", "deployment_version")
    assert got == [("1", "v2"), ("2", "v1")]
    assert rows(qg.unscored(notes(DATA), notes([]))) == rows(notes(DATA))


def test_invalid_answers_fail_or_are_set_aside(notes):
    df = notes([("1", "v1", "x" * 11, "a"), ("2", "v1", "x", "a")])
    with pytest.raises(Exception, match="good: noul is not in"):
        qg.score(df, SPEC, EXPRESSION).count()
    evals, aside = qg.score_and_split(df.union(df), SPEC, EXPRESSION)
    assert [r[0] for r in rows(evals)] == ["2", "2"]
    assert rows(aside) == [("1", "v1", "good: noul is not in [0, 1]")]


def test_expression_evaluation_fields(notes):
    got = qg.score(notes(DATA[3:4]), SPEC, EXPRESSION, unique=True).first()
    assert (got.backend, got.latency_ms, got.cost_usd) == ("expression", 0.0, 1000 / 1e6 * 0.042)
    assert got.answers["kind"].asDict() == {
        "key": "kind", "type": "choice", "noul": None, "choice": "b", "score": None, "confidence": 0.5,
    }
    assert (got.answers["depth"].score, got.answers["depth"].confidence) == (3.0, 1.0)
    with pytest.raises(ValueError):
        qg.ExpressionEvaluator({"unknown": "1"}).answers(notes(DATA), SPEC)


def test_unique_scoring_runs_in_one_stage(spark, tmp_path, notes):
    notes(DATA).write.parquet(str(tmp_path / "n"))
    df = spark.read.parquet(str(tmp_path / "n"))
    plan = qg.score(df, SPEC, EXPRESSION, unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


# --- batch evaluator -----------------------------------------------------------

FAST = Options(batch_size=3, max_retries=3, first_backoff_s=0.0, max_concurrency=2)


def marks(tmp_path):
    """A folder in which the workers leave one file per event."""
    folder = tmp_path / "marks"
    folder.mkdir()

    def mark(name):
        import uuid

        (folder / f"{name}-{uuid.uuid4().hex}").touch()

    return mark, lambda name: len(list(folder.glob(f"{name}-*")))


def good(state, questions):
    return state.assign(
        good=state["note"].str.len() / 10.0, kind=state["kind"], depth=2.0, tokens=1000, **{"kind.confidence": 0.5}
    )


def numbered(notes, n=10):
    return notes([(str(i), "v1", "x" * (i % 10), "a") for i in range(n)])


def by_value(fn):
    """Ship a test scorer to the workers together with what it refers to."""
    def scorer(state, questions):
        return state.assign(
            good=state["note"].str.len() / 10.0, kind=state["kind"], depth=2.0, tokens=1000, **{"kind.confidence": 0.5}
        )

    def run(state, questions):
        return fn(state, questions, scorer)

    return run


def test_batch_equals_expression(notes, tmp_path):
    mark, marked = marks(tmp_path)

    def scorer(state, questions, answer):
        mark(f"call{len(state)}")
        assert list(state.columns) == ["note", "kind"] and list(questions) == ["good", "kind", "depth"]
        return answer(state, questions)

    evals = qg.score(numbered(notes), SPEC, qg.BatchEvaluator(by_value(scorer), options=FAST))
    got = evals.collect()
    assert {(r.row_id, round(r.quality, 9)) for r in got} == {(str(i), quality(i)) for i in range(10)}
    assert {r.backend for r in got} == {"batch"} and {r.cost_usd for r in got} == {1000 / 1e6 * 0.042}
    assert all(r.latency_ms > 0 for r in got)
    assert {r.answers["depth"].score for r in got} == {3.0}
    assert marked("call1") + marked("call2") + marked("call3") >= 4 and marked("call4") == 0


def test_equal_keys_are_scored_once(notes, tmp_path):
    mark, marked = marks(tmp_path)

    def scorer(state, questions, answer):
        for _ in range(len(state)):
            mark("row")
        return answer(state, questions)

    df = numbered(notes)
    evals = qg.score(df.union(df), SPEC, qg.BatchEvaluator(by_value(scorer), options=FAST))
    assert len(evals.collect()) == 20
    assert marked("row") == 10


def test_a_failed_call_is_repeated(notes, tmp_path):
    mark, marked = marks(tmp_path)
    flag = tmp_path / "failed"

    def scorer(state, questions, answer):
        mark("call")
        if not flag.exists():
            flag.touch()
            raise OSError("busy")
        return answer(state, questions)

    one_batch = Options(batch_size=16, max_retries=3, first_backoff_s=0.0, max_concurrency=1)
    evals = qg.score(numbered(notes, 4), SPEC, qg.BatchEvaluator(by_value(scorer), options=one_batch))
    assert len(evals.collect()) == 4
    assert marked("call") == 5


def test_one_bad_row_is_set_aside_alone(notes, tmp_path):
    mark, marked = marks(tmp_path)

    def scorer(state, questions, answer):
        if (state["note"] == "xxx").any():
            mark("bad")
            raise ValueError("cannot read this")
        return answer(state, questions)

    batches = qg.BatchEvaluator(by_value(scorer), options=FAST, on_error="quarantine")
    result = qg.score_with_errors(numbered(notes), SPEC, batches)
    got = result.collect()
    assert {r.row_id for r in got if r.error is None} == {str(i) for i in range(10) if i != 3}
    assert [(r.row_id, r.error, r.answers) for r in got if r.error] == [("3", "cannot read this", None)]
    assert marked("bad") == 3


@pytest.mark.parametrize(
    "change,message",
    [
        (lambda out: out.drop(columns="good"), "no answer for"),
        (lambda out: out.assign(good=1.5), "noul is not in"),
        (lambda out: out.assign(good=None), "good: no noul"),
        (lambda out: out.assign(depth=None), "depth: no score"),
        (lambda out: out.assign(**{"kind.confidence": -1.0}), "confidence is not in"),
        (lambda out: out.iloc[:-1], "rows for"),
    ],
)
def test_unusable_responses_end_the_job_after_all_attempts(notes, change, message):
    def scorer(state, questions, answer):
        return change(answer(state, questions))

    batches = qg.BatchEvaluator(by_value(scorer), options=FAST)
    with pytest.raises(Exception, match=f"evaluation failed after 3 attempts.*{message}"):
        qg.score(numbered(notes, 2), SPEC, batches).collect()


def test_missing_confidence_and_tokens_have_defaults(notes):
    def scorer(state, questions, answer):
        return answer(state, questions)[["good", "kind", "depth"]]

    got = qg.score(numbered(notes, 1), SPEC, qg.BatchEvaluator(by_value(scorer), options=FAST)).first()
    assert (got.cost_usd, got.answers["kind"].confidence) == (0.0, 1.0)


def test_throttle_sets_the_number_of_calls_in_flight(notes, tmp_path):
    def scorer(state, questions, answer):
        import time
        import uuid

        name = tmp_path / uuid.uuid4().hex
        began = time.time()
        time.sleep(0.05)
        name.write_text(f"{began} {time.time()}")
        return answer(state, questions)

    df = numbered(notes, 60).repartition(7)
    batches = qg.BatchEvaluator(by_value(scorer), options=FAST, task_rows=3)
    at_once = qg.BatchEvaluator(by_value(scorer), options=FAST, throttle=False)
    got = rows(batches.answers(df, SPEC), "row_id", "error")
    spans = [tuple(map(float, f.read_text().split())) for f in tmp_path.iterdir()]
    assert max(sum(a <= began < b for a, b in spans) for began, _ in spans) <= FAST.max_concurrency
    assert at_once.answers(df, SPEC).rdd.getNumPartitions() == 7
    assert got == rows(at_once.answers(df, SPEC), "row_id", "error")


def test_a_queue_goes_on_where_it_was_killed(spark, notes, tmp_path, monkeypatch):
    calls, folder = tmp_path / "calls", str(tmp_path / "queue")
    calls.mkdir()
    monkeypatch.setattr("qualitygate.plans.work_queue.FILES_PER_SLOT", 1)

    def evaluator(broken):
        def scorer(state, questions, answer):
            import uuid

            if broken and (calls / "enough").exists():
                raise RuntimeError("lost")
            name = calls / uuid.uuid4().hex
            name.write_text("\n".join(state["note"]))
            if broken and len(list(calls.iterdir())) > 12:
                (calls / "enough").write_text("")
            return answer(state, questions)

        options = Options(batch_size=2, max_retries=1, first_backoff_s=0.0, max_concurrency=2)
        return qg.BatchEvaluator(by_value(scorer), options=options, task_rows=4, name="paid")

    df = notes([(str(i), "v1", f"text {i}", "a") for i in range(80)] + [("3", "v1", "text 3", "a")])
    with pytest.raises(Exception, match="lost"):
        qg.score_queued(df, SPEC, evaluator(True), folder)
    before = {line for f in calls.iterdir() for line in f.read_text().split("\n") if line}
    (calls / "enough").unlink()
    done = {r.row_id for r in spark.read.parquet(folder + "/results").collect()}
    assert 0 < len(done) < 80 and len(before) >= len(done)
    first = {f.name for f in calls.iterdir()}
    # other rows, even with the keys known, change nothing: the queue holds what it was filled with
    evals, bad = qg.score_queued(df.limit(3), SPEC, evaluator(False), folder)
    assert rows(evals, "row_id") == sorted([(str(i),) for i in range(80)] + [("3",)], key=repr) and bad.count() == 0
    again = [line for f in calls.iterdir() if f.name not in first for line in f.read_text().split("\n") if line]
    assert len(again) == len(set(again)) == 80 - len(done)
    assert not {f"text {i}" for i in done} & set(again)
    calls_made = len(list(calls.iterdir()))
    assert qg.score_queued(df, SPEC, evaluator(False), folder)[0].count() == 81
    assert len(list(calls.iterdir())) == calls_made
    plan = spark.read.parquet(folder + "/results")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_a_long_queue_takes_no_more_turns(spark, notes, tmp_path, monkeypatch):
    monkeypatch.setattr("qualitygate.plans.work_queue.FILES_PER_SLOT", 1)
    monkeypatch.setattr("qualitygate.plans.work_queue.TURNS", 2)

    def scorer(state, questions, answer):
        return answer(state, questions)

    def turns(n):
        folder = str(tmp_path / f"queue-{n}")
        batches = qg.BatchEvaluator(by_value(scorer), options=Options(batch_size=8, max_concurrency=2), task_rows=1)
        evals, bad = qg.score_queued(notes([(str(i), "v1", f"text {i}", "a") for i in range(n)]), SPEC, batches, folder)
        assert rows(evals, "row_id") == sorted(((str(i),) for i in range(n)), key=repr) and bad.count() == 0
        return len([f for f in (Path(folder) / "progress" / "commits").iterdir() if f.name.isdigit()])

    assert turns(3) == 2  # files of one row, as asked for
    assert turns(40) <= 4 and turns(160) <= 4  # a partition may end with a file that is not full


def test_throttled_scoring_of_many_rows_takes_no_more_turns(notes, tmp_path, monkeypatch):
    monkeypatch.setattr("qualitygate.plans.work_queue.FILES_PER_SLOT", 1)
    monkeypatch.setattr("qualitygate.plans.work_queue.TURNS", 2)

    def scorer(state, questions, answer):
        return answer(state, questions)

    options = Options(batch_size=8, max_concurrency=2)
    batches = qg.BatchEvaluator(by_value(scorer), options=options, task_rows=1, queue=str(tmp_path / "queue"))
    evals = qg.score(notes([(str(i), "v1", f"text {i}", "a") for i in range(60)]), SPEC, batches, unique=True)
    assert rows(evals, "row_id") == sorted(((str(i),) for i in range(60)), key=repr)
    assert len([f for f in (tmp_path / "queue" / "progress" / "commits").iterdir() if f.name.isdigit()]) <= 4


def test_an_empty_queue_has_no_results(notes, tmp_path):
    def scorer(state, questions, answer):
        return answer(state, questions)

    evals, bad = qg.score_queued(notes([]), SPEC, qg.BatchEvaluator(by_value(scorer), options=FAST), str(tmp_path / "q"))
    assert evals.count() == bad.count() == 0


@pytest.mark.parametrize("limit", [100_000, 0])
@pytest.mark.parametrize("copies", [1, 2])
def test_bookkeeping_columns_stay_whatever_repeats(notes, monkeypatch, limit, copies):
    monkeypatch.setattr(scoring, "BROADCAST_ROWS", limit)
    df = notes(DATA[:1] * copies + [("7", "v1", "w", "b")]).withColumn("_from", F.lit("here"))
    got = scoring.first_per_key(df)
    assert got.columns == [*df.columns, "_copies"]
    assert rows(got, "row_id", "_from", "_copies") == [("1", "here", copies), ("7", "here", 1)]


def test_raw_responses_of_any_shape(notes):
    bodies = {
        "fine": '{"good": 1, "kind": {"value": "a", "confidence": 0.5}, "depth": {"value": 3.0}, "tokens": 1000, "more": []}',
        "null": '{"good": null, "kind": "a", "depth": 3}',
        "missing": '{"kind": "a", "depth": 3}',
        "bool": '{"good": true, "kind": "a", "depth": 3}',
        "empty object": '{"good": 1, "kind": {}, "depth": 3}',
        "list": '{"good": 1, "kind": "a", "depth": [3]}',
        "confidence": '{"good": 1, "kind": {"value": "a", "confidence": "high"}, "depth": 3}',
        "range": '{"good": 1, "kind": {"value": "a", "confidence": 7}, "depth": 3}',
        "array": "[1]",
        "broken": '{"good": 1',
        "none": None,
    }
    df = notes([(name, "v1", "w", "a") for name in bodies])
    response = F.coalesce(*[F.when(F.col("row_id") == name, F.lit(body)) for name, body in bodies.items()])
    got = {r.row_id: r for r in qg.score_with_errors(df.withColumn("response", response), SPEC, qg.ResponseEvaluator()).collect()}
    assert {name: r.error for name, r in got.items()} == {
        "fine": None,
        "null": "good: no answer",
        "missing": "good: no answer",
        "bool": "good: boolean is no noul",
        "empty object": "kind: no answer",
        "list": "depth: array is no score",
        "confidence": "kind: string is no confidence",
        "range": "kind: confidence is not in [0, 1]",
        "array": "the response is no JSON object",
        "broken": "the response is no JSON object",
        "none": "the response is no JSON object",
    }
    fine = got["fine"]
    assert (fine.answers["kind"].choice, fine.answers["kind"].confidence, fine.answers["depth"].score) == ("a", 0.5, 3.0)
    assert round(fine.quality, 9) == round(0.5 + 0.2 * 0.5 + 0.3 * 0.5, 9) and fine.cost_usd > 0
    assert all(r.answers is None and r.quality is None for name, r in got.items() if name != "fine")


def test_registry():
    qg.register_evaluator("Mine", lambda: EXPRESSION)
    assert qg.get_evaluator(" mine ") is EXPRESSION
    with pytest.raises(ValueError, match="mine"):
        qg.get_evaluator("other")
    with pytest.raises(ValueError):
        qg.BatchEvaluator(good, on_error="ignore")
