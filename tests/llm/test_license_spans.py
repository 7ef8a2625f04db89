import re

import pytest

from tripwire.llm import license_spans as lic

GAPS = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = [(t.label, t.text.split()) for t in lic.TEMPLATES if t.base]
ROWS = [
    (1, "All Rights Reserved. all rights, reserved CC-BY cc by cc BY"), (2, "GNU General Public License, version 3"),
    (3, "Licensed under the very Apache License, Version 2.0"), (4, "all rightsé reserved general public"),
    (5, None), (6, ""), (7, "Released under the MIT License."), (7, "all rights reserved " * 3000), (None, "cc by"), (None, "cc by"),
    (8, "version 2 0 the under licensed apache license"),
]


def brute(text):
    w = [x for x in GAPS.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    at = [(i, label) for label, phrase in BASE for i in range(len(w)) if w[i:i + len(phrase)] == phrase]
    starts = [i for i, _ in at]
    return (len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at})))


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def test_base_places_equal_a_scan_in_plain_python(rows, docs, odd):
    for table in (rows, docs, odd):
        got = lic.scan(table.select("doc_id", "text")).collect()
        want = table.select("doc_id", "text").collect()
        assert sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got) == sorted(
            str((r.doc_id, *brute(r.text))) for r in want)
        assert all(0 <= r.score <= 1 for r in got)


def test_added_labels(rows):
    labels = {r.doc_id: r.labels for r in lic.scan(rows.filter("doc_id != 7 or length(text) < 100")).collect()}
    assert labels[2] == "gpl,gpl-3" and labels[3] == "apache-2.0" and labels[7] == "mit"
    assert labels[8] == labels[6] == labels[4] == ""


def test_no_documents(rows):
    assert lic.scan(rows.limit(0)).collect() == []


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


MIT = next(t.text.split() for t in lic.TEMPLATES if t.label == "mit" and len(t.text.split()) > 64)


def edited(words, at):
    return [w for i, w in enumerate(words) for w in ([w] if i not in at else at[i])]


def test_whole_licenses_with_edits_are_found_and_shuffled_words_are_not(spark):
    parts = [MIT[i:i + 4] for i in range(0, len(MIT), 4)]
    texts = {
        1: MIT, 2: ["x"] * 50 + MIT + ["y"] * 50, 3: edited(MIT, {20: ["any"], 40: [], 60: ["other", "words"]}),
        4: [w for part in reversed(parts) for w in part], 5: MIT[:30], 6: [w for part in parts for w in (part[2:] + part[:2])],
    }
    rows = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], "doc_id long, text string")
    one = tuple(t for t in lic.TEMPLATES if t.text.split() == MIT)
    found = {r.doc_id: r for r in lic.find_spans(rows, one).collect()}
    assert set(found) == {1, 2, 3}
    assert (found[1].start, found[1].end, found[1].cover) == (0, len(MIT), 1.0)
    assert (found[2].start, found[2].end, found[2].cover) == (50, 50 + len(MIT), 1.0)
    assert abs(found[3].cover - (1 - levenshtein(texts[3], MIT) / len(MIT))) < 1e-9


def test_templates_of_any_length(spark):
    words = [f"w{i % 150}" for i in range(400)]
    rows = spark.createDataFrame([(1, " ".join(["a"] * 3 + words)), (2, " ".join(words[:200])), (3, "w0 w1")], "doc_id long, text string")
    spans = lic.find_spans(rows, (lic.Template("long", " ".join(words)), lic.Template("two", "w0 w1", True))).collect()
    assert {(r.doc_id, r.start, r.end, r.cover) for r in spans if r.label == "long"} == {(1, 3, 403, 1.0)}
    assert sorted((r.doc_id, r.start) for r in spans if r.label == "two") == [(1, 3), (1, 153), (1, 303), (2, 0), (2, 150), (3, 0)]
    with pytest.raises(ValueError):
        lic.template_pairs(spark, (lic.Template("one", "word"),))


def test_added_labels_equal_an_alignment_of_every_window(rows, docs):
    """Brute force: the best edit similarity of a template and any window of the text, among texts with a close one."""
    def similarity(w, t):
        sizes = range(max(len(t) - 2, 1), len(t) + 3)
        return max((1 - levenshtein(w[i:i + n], t) / len(t) for n in sizes for i in range(max(len(w) - n, 0) + 1)), default=0)

    short = [t for t in lic.TEMPLATES if not t.base and len(t.text.split()) < 10]
    few = docs.select("doc_id", "text").filter("length(text) < 600 and lower(text) like '%licen%'").limit(20).union(
        rows.filter("length(text) < 300 and doc_id is not null"))
    got = {(r.doc_id, r.label) for r in lic.find_spans(few, tuple(short)).collect()}
    for r in few.collect():
        w = [x for x in GAPS.split((r.text or "").lower()) if x]
        for t in short:
            best = similarity(w, t.text.split())
            if best == 1:
                assert (r.doc_id, t.label) in got
            if (r.doc_id, t.label) in got and sum(x.label == t.label for x in short) == 1:
                assert best >= lic.COVER
