"""Operator 6 against brute force."""

from __future__ import annotations

import random

from rareseries.llm.line_dedup import line_copies


def near(a, b):
    """At most one edit apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def judged(rows):
    """(id, line number) of the lines that go, by brute force."""
    places = [(i, n, t) for i, text in rows if text is not None for n, t in enumerate(text.split("\n")) if len(t) >= 20]
    first = {}
    for i, n, t in sorted(places):
        first.setdefault(t, (i, n))
    return {(i, n) for i, n, t in places if first[t] < (i, n) or any(near(t, o) and first[o] < first[t] for o in first if o != t)}


def check(got, rows):
    gone, got = judged(rows), {r["doc_id"]: r for r in got.collect()}
    for i, text in rows:
        lines = [] if text is None else text.split("\n")
        keep = [t for n, t in enumerate(lines) if (i, n) not in gone]
        assert (got[i]["n_lines"], got[i]["n_removed"]) == (len(lines), len(lines) - len(keep))
        assert got[i]["kept_text"] == (None if text is None else "\n".join(keep))


def test_line_copies(spark):
    rng = random.Random(6)
    base = ["".join(rng.choices("abé ", k=rng.randint(18, 26))) for _ in range(12)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 4)):
            t = rng.choice(base)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(t))
                t = t[:at] + rng.choice(["", "x", "xy"]) + t[at + rng.randint(0, 1) :]
            lines.append(t)
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "short\nshort")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(line_copies(docs, hot=1), rows)
    check(line_copies(docs), rows)
    assert line_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_segments_that_many_lines_share(spark):
    """A third of the lines open alike, others end alike, some differ in one place only (by a letter, or one more)."""
    rng = random.Random(66)
    lines = ["a common beginning of " + "".join(rng.choices("xyz", k=rng.randint(3, 6))) for _ in range(60)]
    lines += ["".join(rng.choices("xyz", k=rng.randint(3, 5))) + " and a common end, always" for _ in range(60)]
    lines += [f"only one letter {c} differs here" for c in "abcdefghijklmnop"] + [f"only one letter {c}q differs here" for c in "abcdefgh"]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[3 * i : 3 * i + 3])) for i in range(len(lines) // 3 + 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(line_copies(docs, hot=2), rows)
    check(line_copies(docs), rows)


def test_rows_without_or_with_the_same_id(spark):
    """Lines of one such row say nothing of the lines of another at the same number."""
    shared = "this line stands in two of them"
    texts = [shared + "\n" + "a line that only the first one has", "a line that only the second has\nshort", shared + "\nkept, as no other row holds this", "\n".join(["x", shared, "the fourth document ends like so"])]
    for ids in ([None] * 4, [7] * 4, [7, None, None, 7]):
        docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(3)
        got = line_copies(docs).collect()
        assert len(got) == 4 and sum(r["n_removed"] for r in got) == 2
        lines = [x for r in got for x in r["kept_text"].split("\n")]
        assert sorted(lines) == sorted({x for t in texts for x in t.split("\n")})


def test_copies_of_short_lines(spark):
    """Exact copies of short lines go if asked; blank ones and those one edit away stay."""
    rows = [(1, "Read more\n\nx"), (2, "Read more\n\n \nRead mare"), (3, "x\n \n\nRead more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["kept_text"] for r in line_copies(docs, short=True).collect()}
    assert got == {1: "Read more\n\nx", 2: "\n \nRead mare", 3: " \n"}
