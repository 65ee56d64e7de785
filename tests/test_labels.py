import json

import numpy as np
import pytest

from themewell.operators import labels, report, represent


SPOTS = {3: [(1, 1), (1, 2), (4, 1), (2, 5), (2, 2), (9, 1)], 8: [(-20, 0), (-21, 3), (-24, 0)], -1: [(50, 50), (0, -70)]}


@pytest.fixture
def plane(spark, vectors_of, assigned_of):
    """Two clusters of unequal size and noise, with a text about each; ids mix the clusters."""
    rows = sorted(((x * 7 + y) % 11, x, y, c) for c, spots in SPOTS.items() for x, y in spots)
    x, clusters = np.array([r[1:3] for r in rows], float), [r[3] for r in rows]
    word = {3: "apple", 8: "bridge", -1: "cloud"}
    texts = spark.createDataFrame([(i, f"the {word[c]} number {i}") for i, c in enumerate(clusters)], "id long, text string")
    return x, vectors_of(x), assigned_of(clusters), texts


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_nearest_to_the_centroid(plane, monkeypatch, limit):
    monkeypatch.setattr(represent, "BROADCAST_BYTES", limit)
    x, vectors, assigned, _ = plane
    clusters = np.array([r.cluster_id for r in assigned.orderBy("id").collect()])
    rows = represent.nearest_to_centroid(vectors, assigned, 4).orderBy("cluster_id", "rank").collect()
    for c in (3, 8):
        members = np.flatnonzero(clusters == c)
        away = np.hypot(*(x[members] - x[members].mean(0)).T).round(9)
        want = [int(i) for _, i in sorted(zip(away, members))][:4]
        assert [(r.id, r.rank) for r in rows if r.cluster_id == c] == [(i, n) for n, i in enumerate(want, 1)]
    assert len(rows) == 4 + 3


def test_distinct_examples(spark):
    nearest = spark.createDataFrame([(0, 1, 7), (0, 2, 8), (0, 3, 9)], "cluster_id int, rank int, id long")
    texts = spark.createDataFrame([(7, "Hi"), (8, "hi"), (9, "yo")], "id long, text string")
    assert represent.examples(nearest, texts).first().examples == ["Hi", "hi", "yo"]
    assert represent.examples(nearest, texts, distinct=True).first().examples == ["Hi", "yo"]


@pytest.fixture
def requests(plane):
    _, vectors, assigned, texts = plane
    nearest = represent.nearest_to_centroid(vectors, assigned)
    return labels.label_requests(assigned, represent.examples(nearest, texts))


def test_prompts_hold_the_examples_and_noise_is_left_out(requests):
    rows = {r.cluster_id: r for r in requests.collect()}
    assert {c: r.size for c, r in rows.items()} == {3: 6, 8: 3}
    for r in rows.values():
        assert [line[2:] for line in r.prompt.splitlines() if line.startswith("- ")] == r.examples
        assert '"label"' in r.prompt and '"description"' in r.prompt


def scripted(replies):
    """A labeler that gives the queued replies in turn, anew for each prompt."""

    def make():
        turn = {}

        def label(prompt):
            n = turn[prompt] = turn.get(prompt, -1) + 1
            reply = replies[min(n, len(replies) - 1)]
            if isinstance(reply, Exception):
                raise reply
            return reply

        return label

    return make


GOOD = json.dumps({"label": "  Refund help ", "description": "About refunds."})


def test_reply_is_parsed(requests):
    rows = labels.apply_labeler(requests, scripted([GOOD])).collect()
    assert {(r.label, r.description, r.status) for r in rows} == {("Refund help", "About refunds.", "done")}


def test_retry_then_success(requests):
    rows = labels.apply_labeler(requests, scripted([ConnectionError("down"), "[1]", GOOD]), retry_delay=0).collect()
    assert {r.status for r in rows} == {"done"}


def test_failures_are_rows_and_strict_raises(requests):
    out = labels.apply_labeler(requests, scripted([ConnectionError("down")]), retry_delay=0)
    assert {(r.status, r.label, r.error) for r in out.collect()} == {("failed", None, "ConnectionError: down")}
    with pytest.raises(RuntimeError, match="down"):
        labels.require_labels(out)


def test_blank_label(requests):
    rows = labels.apply_labeler(requests, scripted([json.dumps({"label": " "})])).collect()
    assert {(r.label, r.description) for r in rows} == {("Unlabeled", "")}


def test_keyword_names(plane):
    _, _, assigned, texts = plane
    terms = labels.keyword_terms(assigned, texts, 2)
    names = {r.cluster_id: r.label for r in labels.keyword_labels(terms).collect()}
    assert names[3].startswith("apple") and names[8].startswith("bridge") and set(names) == {3, 8}


def test_catalogue_is_sorted_by_size(spark, assigned_of):
    assigned = assigned_of([0, 1, 1, -1])
    names = spark.createDataFrame([(0, "one", "d"), (1, "two", "d")], "cluster_id int, label string, description string")
    ex = spark.createDataFrame([(1, list("abcdefgh"))], "cluster_id int, examples array<string>")
    rows = report.cluster_catalogue(assigned, names, ex).collect()
    assert [(r.cluster_id, r.label, r.size, r.share) for r in rows] == [(1, "two", 2, 50.0), (0, "one", 1, 25.0)]
    assert rows[0].examples == list("abcde") and rows[1].examples is None
