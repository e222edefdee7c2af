import random
import re
from collections import defaultdict

import pytest
import xxhash
from texts import documents, prose, rows

from swipelake.llm import line_chunks

MASK = (1 << 64) - 1


def n_words(line):
    return len(re.findall(r"[^ \t-\r]+", line))


def is_long(line):
    return n_words(line) >= line_chunks.LONG_WORDS


def chunks(text):
    lines, out, first = text.split("\n"), [], 0
    hashes = [xxhash.xxh64_intdigest(line.encode(), 42) for line in lines]
    for i, line in enumerate(lines):
        before = hashes[i - 1] if i else 0
        rolling = hashes[i] ^ ((before << 1 | before >> 63) & MASK)
        if i == len(lines) - 1 or (rolling >> 33) % line_chunks.DIVISOR == 0 or is_long(line) or is_long(lines[i + 1]):
            out.append((first, i - first + 1, "\n".join(lines[first : i + 1])))
            first = i + 1
    return out


def eligible(chunk):
    return n_words(chunk[2]) >= line_chunks.LEAST_WORDS if chunk[1] > 1 else is_long(chunk[2])


def brute(docs):
    """(key, text) without repeated chunks; the least occurrence stays, null keys last."""
    order = lambda k, c: (k is None, k or 0, c[0])
    places = defaultdict(list)
    for k, t in docs:
        for c in chunks(t) if t is not None else []:
            if eligible(c):
                places[c[2]].append(order(k, c))
    out = []
    for k, t in docs:
        if t is not None:
            t = "\n".join(c[2] for c in chunks(t) if not eligible(c) or order(k, c) == min(places[c[2]]))
        out.append((k, t))
    return sorted(out, key=str)


def corpus():
    r = random.Random(1)
    passages = ["\n".join(prose(f"{p}/{i}", r.randint(8, 25)) for i in range(12)) for p in range(6)]
    out = []
    for d in range(60):
        parts = [prose(f"own {d}/{i}", r.randint(1, 30)) for i in range(r.randint(0, 6))]
        for _ in range(r.randint(0, 2)):
            parts.insert(r.randint(0, len(parts)), r.choice(passages))
        out.append((d, "\n".join(parts), "en", "a"))
    return out + rows() + [(None, passages[0], "en", "a"), (None, passages[0], "en", "a"), (70, "\n\n\n", "en", "a"), (7, prose("x", 80), "en", "a")]


def test_same_as_brute_force(spark):
    docs = corpus()
    got = line_chunks.dedup(documents(spark, docs).drop("n_lines")).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == brute([(r[0], r[1]) for r in docs])
    for r in got:
        assert r.n_removed == r.n_lines - (0 if r.text is None else len(r.text.split("\n")) if r.text or r.n_removed < r.n_lines else 0)


def test_edges_move_with_the_text():
    """Lines put in front change no chunk behind the next edge."""
    text = "\n".join(prose(i, 12) for i in range(40))
    more = "\n".join(prose(f"new {i}", 12) for i in range(3)) + "\n" + text
    assert len({c[2] for c in chunks(text)} - {c[2] for c in chunks(more)}) <= 1


def test_long_lines_are_passages(spark):
    passage = prose("p", 60)
    docs = documents(spark, [(i, f"{prose(i, 12)}\n{passage}\n{prose(-i, 12)}", "en", "a") for i in range(1, 9)])
    left = {r.doc_id: r.text for r in line_chunks.dedup(docs, counts=False).collect()}
    assert passage in left[1] and not any(passage in left[i] for i in range(2, 9))
    assert all(left[i].split("\n") == [prose(i, 12), prose(-i, 12)] for i in range(2, 9))


def test_other_columns_stay(spark):
    docs = documents(spark)
    kept = line_chunks.dedup(docs, counts=False)
    assert kept.columns == docs.columns and kept.select("gone_chunks", "key", "left_text").distinct().collect() == [("g", "k", "l")]


@pytest.mark.parametrize("classes", [1, 7])
def test_names_that_different_texts_share(spark, monkeypatch, classes):
    """Texts decide where all pieces, or many, have one name."""
    from pyspark.sql import functions as F

    docs = corpus()
    monkeypatch.setattr(line_chunks, "name_of", lambda h: F.pmod(F.xxhash64(h), F.lit(classes)))
    got = line_chunks.dedup(documents(spark, docs), counts=False).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == brute([(r[0], r[1]) for r in docs])
    short = shaped()
    left = {r.doc_id: r.text for r in line_chunks.dedup(documents(spark, [(*d, "en", "a") for d in short]), runs=True).collect()}
    assert [left[i] for i, _ in short] == without_runs(short)


def test_same_result_without_broadcast(spark, monkeypatch):
    docs = corpus()
    monkeypatch.setattr(line_chunks, "BROADCAST_ROWS", 0)
    got = line_chunks.dedup(documents(spark, docs), counts=False).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == brute([(r[0], r[1]) for r in docs])


CODE = "\n".join(" " * indent + "}" for indent in (16, 12, 8, 4, 0))


@pytest.mark.parametrize("shared", [CODE, " " * 100, "\n".join([" " * 60] * 4), "\t" * 80 + "\n" + " \t" * 40])
def test_blanks_are_no_words(spark, shared):
    """Indented code and padded lines that all documents share stay whole."""
    docs = [(i, f"{prose(i, 9)}\n{shared}\n{prose(-i, 9)}", "en", "a") for i in range(1, 9)]
    left = {r.doc_id: r.text for r in line_chunks.dedup(documents(spark, docs), counts=False, runs=True).collect()}
    assert left == {d[0]: d[1] for d in docs}


def test_words_parted_by_tabs_are_words(spark):
    passage = prose("tabs", 60).replace(" ", "\t")
    docs = [(i, f"{prose(i, 12)}\n{passage}\n{prose(-i, 12)}", "en", "a") for i in range(1, 5)]
    left = {r.doc_id: r.text for r in line_chunks.dedup(documents(spark, docs), counts=False).collect()}
    assert passage in left[1] and not any(passage in left[i] for i in (2, 3, 4))


@pytest.mark.parametrize("counts", [True, False])
def test_empty_table(spark, counts):
    assert line_chunks.dedup(documents(spark, []), counts=counts).count() == 0


@pytest.mark.parametrize("key", [None, 5])
def test_rows_of_one_key_are_documents_of_their_own(spark, key):
    """A third of the rows have one key, or none; copies among them go as others do."""
    passage = "\n".join(prose(f"one key {i}", 15) for i in range(12))
    docs = [(key if i % 3 == 0 else 100 + i, f"{passage}\n{prose(i, 3)}" if i % 3 == 0 else prose(i, 30), "en", "a") for i in range(90)]
    docs += [(key, prose("copy", 60), "en", "a")] * 4
    left = [r.text for r in line_chunks.dedup(documents(spark, docs), counts=False).collect()]
    whole = [c[2] for c in chunks(passage)[:-1] if eligible(c)]
    assert len(whole) > 1 and len(left) == 94
    assert all(sum(c in t for t in left) == 1 for c in whole)
    assert left.count(prose("copy", 60)) == 1


def without_runs(docs, least=line_chunks.RUN_WORDS):
    """Texts without the lines of windows that came before: every run of lines, all pairs, in order of the rows."""
    seen, out = {}, []
    for d, (_, t) in enumerate(docs):
        lines = t.split("\n")
        gone = set()
        for a in range(len(lines)):
            for b in range(a, min(len(lines), a + 60)):
                run = tuple(lines[a : b + 1])
                if sum(map(n_words, run)) >= least:
                    e, f = seen.setdefault(run, (d, a))
                    gone |= set(range(max(a, f + len(run)) if e == d and (e, f) != (d, a) else a, b + 1)) if (e, f) != (d, a) else set()
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


SHAPES = [(3, 20), (4, 15), (5, 12), (6, 10), (10, 10), (2, 26), (20, 3), (17, 3), (20, 10), (2, 100)]


def shaped():
    """Passages of 51 to 200 words over 2 to 20 lines, each three times between different neighbours."""
    r, out = random.Random(8), []
    for s, (n, words) in enumerate(SHAPES):
        passage = "\n".join(prose(f"shape {s}/{i}", words) for i in range(n))
        for c in range(3):
            parts = ["\n".join(prose(f"{s} {c} {side} {k}", r.randint(3, 14)) for k in range(r.randint(1, 4))) for side in "ab"]
            out.append((len(out), f"{parts[0]}\n{passage}\n{parts[1]}"))
    return out


def test_whole_passages_go(spark):
    docs = shaped()
    left = {r.doc_id: r for r in line_chunks.dedup(documents(spark, [(*d, "en", "a") for d in docs]), runs=True).collect()}
    want = without_runs(docs)
    assert [left[i].text for i, _ in docs] == want
    assert all(left[i].n_removed == SHAPES[i // 3][0] if i % 3 else left[i].text == t for i, t in docs)


def test_runs_end_with_the_passage(spark):
    """Of 50 words or fewer in lines of their own nothing is a run; a passage that repeats in itself stays once."""
    line = [prose(f"in itself {i}", 20) for i in range(3)]
    short = prose("short", 10)
    docs = [(1, "\n".join(line * 4)), (2, f"{prose(1, 7)}\n{short}\n{prose(2, 7)}"), (3, f"{prose(3, 7)}\n{short}\n{prose(4, 7)}")]
    left = {r.doc_id: r.text for r in line_chunks.dedup(documents(spark, [(*d, "en", "a") for d in docs]), counts=False, runs=True).collect()}
    assert set(line) <= set(left[1].split("\n")) and len(left[1].split("\n")) < 6
    assert all(left[i] == t for i, t in docs[1:])


def test_runs_take_more_than_chunks(spark):
    docs = documents(spark, corpus()).select("doc_id", "text")
    chunked = sum(r.n_removed for r in line_chunks.dedup(docs).collect())
    whole = line_chunks.dedup(docs, runs=True).collect()
    assert sum(r.n_removed for r in whole) > chunked
    assert {x for r in docs.collect() for x in (r.text or "").split("\n")} - {x for r in whole for x in (r.text or "").split("\n")} <= {""}
