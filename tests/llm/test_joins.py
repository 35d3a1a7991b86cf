import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tickframe.llm import decontaminate, lines
from tickframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute_contamination(docs, items):
    windows = {}
    for item, t in items:
        w = WORD.findall(lower(t))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    out = {}
    for doc, t in docs:
        w, hit, found = WORD.findall(lower(t)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[k]
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def result(rows):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_contamination_of_corpus(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()
    rows = QUERIES["op1_benchmark_index"](spark, sf).collect()
    assert len(rows) == len(docs)
    want = brute_contamination(docs, items)
    assert result(rows) == want and any(x[1] for x in want.values())
    assert all(r.n_near_items >= r.n_items for r in rows)


def test_contamination_cases(spark):
    items = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short Item"), (3, None), (4, "--"), (5, "a a a a a a a a a a a"),
             (1, "one two three four five six seven eight nine ten eleven"), (None, "x y"), (6, "é\x00Ü 漢字")]
    docs = [(1, "zero ONE two,three four-five six seven eight nine ten eleven twelve short item"), (2, None), (3, ""), (4, "a " * 25), (5, "one two three four five X six seven eight nine ten"),
            (6, "é Ü 漢字"), (7, "x y"), (8, "ONE two three four five six seven eight nine ten"), (8, "ONE two three four five six seven eight nine ten"), (None, "short item")]
    d = spark.createDataFrame([(*x, "z", 1) for x in docs], "doc_id long, text string, term string, window int")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.report(decontaminate.contamination(d, b)).collect()
    assert len(rows) == 8
    assert result(rows) == brute_contamination([x for x in docs if x[0]], [x for x in items if x[0]])
    assert {r.doc_id: r.n_near_items for r in rows}[5] == 1  # one word more inside: near, not exact
    assert decontaminate.clean(d, b).count() == 5
    assert decontaminate.contamination(d.limit(0), b).count() == 0
    assert decontaminate.report(decontaminate.contamination(d, b.limit(0))).where("contaminated").count() == 0


def brute_lines(docs, threshold):
    seen, out, cache = [], {}, {}
    for doc, t in sorted((d for d in docs if d[0] is not None), key=lambda d: d[0]):
        kept, n = [], 0
        for line in (t or "").split("\n"):
            s = frozenset(re.findall("[^\x20\x09-\x0d]+", lower(line)))
            if s and (cache[s] if s in cache else any(min(len(s), len(o)) >= threshold * max(len(s), len(o)) - 1e-9 and len(s & o) >= threshold * len(s | o) - 1e-9 for o in seen)):
                n += 1
            else:
                kept.append(line)
            if s and s not in cache:
                seen.append(s)
                cache[s] = True
        out[doc] = (n, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def test_lines_of_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op7_line_join"](spark, SF).collect()
    want = brute_lines(docs, lines.THRESHOLD)
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in rows} == want and sum(x[0] for x in want.values()) > 10


@pytest.mark.parametrize("threshold", [0.6, 0.9])
def test_line_cases(spark, threshold):
    base = [f"w{i}" for i in range(20)]
    docs = [(1, " ".join(base) + "\n\nshort line\nshort line"), (2, None), (3, ""), (4, "SHORT\tline\r\nother"), (5, "other\nfresh text here")]
    docs += [(10 + i, " ".join([*base[:i], f"x{i}", *base[i + 1:]]) + f"\nown {i}") for i in range(20)]
    docs += [(40 + i, " ".join([*base[:10], *(f"y{j}" for j in range(i, i + 10))])) for i in range(12)]
    d = spark.createDataFrame([(*x, "z", 9) for x in docs] + [(None, "short line", None, None)], "doc_id long, text string, h string, n_chars long")
    out = lines.remove_repeated(d, threshold)
    rows = out.collect()
    got = {r.doc_id: (r.n_removed, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows if r.doc_id is not None}
    assert got == brute_lines(docs, threshold)
    assert len(rows) == len(docs) + 1 and out.columns[:4] == d.columns
    assert lines.remove_repeated(d.limit(0)).count() == 0


def test_lines_of_few_words_with_one_replaced(spark, tmp_path):
    base = [f"w{i}" for i in range(25)]
    docs = [(1, " ".join(base[:10]) + "\n" + " ".join(base)), (2, " ".join([*base[:9], "x"])),  # 9 of 11
            (3, " ".join([*base[:23], "x", "y"])), (4, " ".join([*base[:8], "p", "q"]))]  # 23 of 27; 8 of 12
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op7_line_join"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.n_removed for r in rows} == {1: 0, 2: 1, 3: 1, 4: 0}


def test_nothing_staged_has_more_rows_than_lines(spark, monkeypatch):
    """Tokens of lines are never written out as rows."""
    rows, write = {}, lines.stage
    monkeypatch.setattr(lines, "stage", lambda df, name: (out := write(df, name), rows.update({name: out.count()}))[0])
    base = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1:]]) + f"\nown {i} of these {i % 7}") for i in range(40)]
    out = lines.remove_repeated(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in out} == {i: n for i, (n, _) in brute_lines(docs, lines.THRESHOLD).items()} and out
    assert rows and max(rows.values()) <= 80


def test_plain_lines_differ_where_their_words_do(spark):
    words = [*(chr(c) for c in (*range(0xA1, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x1F00), *range(0x4E00, 0x4E80), *range(0x1F600, 0x1F640)) if not chr(c).isspace()), "É", "É9", "aé", "AÉ", "ãa", "日É"]
    rows = spark.createDataFrame([(w,) for w in words], "text string").select("text", lines._plain(F.col("text")).alias("plain")).collect()
    assert len({r.plain for r in rows}) == len({lower(w) for w in words})
    assert {lower(a.text) == lower(b.text) for a in rows for b in rows if a.plain == b.plain} == {True}
    mixed = spark.createDataFrame([("É\tB\r\x0bÜber",)], "text string").select(lines.tokens(lines._plain(F.col("text")))).first()[0]
    assert len(mixed) == 3


def test_texts_that_share_a_doc_id(spark):
    """Lines and postings of one text are never taken for another's."""
    docs = [(1, "hello world foo bar baz"), (2, "hello world foo bar baz\nx"), (2, "entirely unique sentence nobody repeats\ny"),
            (2, "entirely unique sentence nobody repeats\ny"), (3, "y\nlast of all\nentirely unique sentence nobody repeats")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in lines.remove_repeated(d).collect())
    assert got == [(1, "hello world foo bar baz", 1, 0), (2, "entirely unique sentence nobody repeats\ny", 2, 0), (2, "entirely unique sentence nobody repeats\ny", 2, 0),
                   (2, "x", 2, 1), (3, "last of all", 3, 2)]
    items = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    split = [(1, "a X c X e X g X i X"), (1, "X b X d X f X h X j"), (2, "z a b c d e f g h i j"), (2, "z a b c d e f g h i j"), (2, "a b c d e f g h i j k l")]
    rows = decontaminate.report(decontaminate.contamination(spark.createDataFrame(split, "doc_id long, text string"), items)).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows} == {1: (20, 0, 0, False), 2: (23, 20, 1, True)}


def test_emptied_documents(spark):
    docs = [(1, "one two three\n\nfour five"), (2, "one two three\n\nfour five"), (3, ""), (4, None), (5, "  "), (6, "four five\nnew words"), (None, "one two three")]
    left = lines.drop_emptied(lines.remove_repeated(spark.createDataFrame(docs, "doc_id long, text string"))).collect()
    assert {r.doc_id: r.text for r in left} == {1: docs[0][1], 3: "", 4: None, 5: "  ", 6: "new words", None: "one two three"}


def test_very_long_texts(spark):
    text = "\n".join(f"line {i} of {i * 7} words {i * 13}" for i in range(30_000))
    d = spark.createDataFrame([(1, text), (2, "line 5 of 35 words 65\nother things here")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in lines.remove_repeated(d, 0.99).collect()} == {1: 0, 2: 1}
    items = spark.createDataFrame([(1, "line 29999 of 209993 words 389987")], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.contamination(d, items).collect()} == {1: 6, 2: 0}
