import hashlib
import re
from collections import Counter, defaultdict

from anchorline.llm.linededup import dedup_lines
from anchorline.llm.substrings import remove_repeats

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_lines(rows, min_docs):
    docs = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if key(line):
                docs[key(line)].add(d)
    gone = {k for k, v in docs.items() if len(v) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


def test_lines(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    for least in (2, 10):
        out = dedup_lines(edge_docs, min_docs=least)
        assert out.columns == [*edge_docs.columns, "n_lines", "n_dropped"]
        assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()) == brute_lines(rows, least)
    assert dedup_lines(no_docs).count() == 0


def brute_repeats(rows, window):
    first = {}
    for d, t in rows:
        w = WORD.findall(t or "")
        for j in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[j : j + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for j in range(len(w) - window + 1):
            if d is not None and first[tuple(w[j : j + window])] < d:
                gone.update(range(j, j + window))
        out.append((d, hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest(), len(w), len(gone)))
    return Counter(out)


def test_repeats(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    out = remove_repeats(edge_docs.drop("id"), window=13)
    got = Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest(), r.n_words, r.n_removed) for r in out.collect())
    assert got == brute_repeats(rows, 13)
    assert remove_repeats(no_docs).count() == 0
    assert set(remove_repeats(edge_docs).columns) == {*edge_docs.columns, "n_words", "n_removed"}


def test_frequent_prefixes_need_no_tree(spark):
    """One passage in most documents: its windows are frequent at full depth and are settled by a plain minimum."""
    passage = " ".join(f"w{i}" for i in range(15))
    rows = [(i, f"{passage} own{i} text{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest(), r.n_words, r.n_removed) for r in remove_repeats(df, group_bytes=500).collect())
    assert got == brute_repeats(rows, 13)
