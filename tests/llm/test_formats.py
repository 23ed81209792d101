import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from anchorline.llm import avi, chat, packing, urltree
from anchorline.llm.queries import URL_RULES, op2_chat_formatting

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=0, max_size=5000))
def test_avi_round_trip(raw):
    payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
    frames, length, rate = avi.read_avi(avi.write_avi(payload))
    assert rate == avi.FPS
    assert b"".join(map(avi.decode_frame, frames))[:length] == payload


def test_avi_shots_and_errors():
    still, other = bytes(range(64)) * 16, b"\xff" * 1024
    h = avi.frame_histograms(still * 4 + other * 3)
    assert avi.shots(h, k=1.0) == [(0, 4), (4, 7)]
    assert avi.shots(h[:1]) == [(0, 1)]
    whole = avi.write_avi(still)
    for broken in (b"", whole[:100], whole[: len(whole) // 2], b"RIFF" + whole[4:8] + b"WAVE" + whole[12:]):
        with pytest.raises(ValueError):
            avi.read_avi(broken)


def foreign_frame(blocks, width, height, quant):
    """A grey baseline frame with flat code tables, from zigzag coefficients of its blocks."""
    import struct

    segment = lambda m, b: struct.pack(">BBH", 0xFF, m, len(b) + 2) + b
    ac = [0, 0xF0, *(r << 4 | n for r in range(16) for n in range(1, 11))]
    head = b"\xff\xd8" + segment(0xE0, b"JFIF\0") + segment(0xDB, b"\x00" + bytes(quant)) + segment(0xC0, struct.pack(">BHHB", 8, height, width, 1) + b"\x01\x11\x00")
    head += segment(0xC4, b"\x00" + bytes([0] * 3 + [12] + [0] * 12) + bytes(range(12))) + segment(0xC4, b"\x10" + bytes([0] * 7 + [len(ac)] + [0] * 8) + bytes(ac)) + segment(0xDA, b"\x01\x01\x00\x00\x3f\x00")
    size = lambda v: int(abs(v)).bit_length()
    bits = lambda v: format(int(v) if v > 0 else int(v) + (1 << size(v)) - 1, f"0{size(v)}b") if v else ""
    out, before = "", 0
    for c in blocks:
        d, before = c[0] - before, c[0]
        out += format(size(d), "04b") + bits(d)
        run = 0
        for v in c[1 : max([i for i in range(64) if c[i]], default=0) + 1]:
            if v == 0:
                run += 1
                continue
            out += format(1, "08b") * (run // 16) + format(ac.index((run % 16) << 4 | size(v)), "08b") + bits(v)
            run = 0
        out += "" if c[63] else format(0, "08b")
    out += "1" * (-len(out) % 8)
    return head + int(out, 2).to_bytes(len(out) // 8).replace(b"\xff", b"\xff\x00") + b"\xff\xd9"


def test_frames_of_other_writers(spark):
    """Frames with other tables, sizes and no restarts; files without a payload length; broken ones give their reason."""
    rng = np.random.default_rng(4)
    quant = rng.integers(1, 9, 64)
    shots, frames = [0] * 6 + [1] * 5, []
    looks = []
    for look in range(2):
        c = np.where(rng.random((6, 64)) < 0.2, rng.integers(-30, 31, (6, 64)), 0)
        c[:, 0] = rng.integers(-100, 100, 6) + 60 * (1 - 2 * look)
        looks.append(c)
    for look in shots:
        frames.append(foreign_frame(looks[look].tolist(), 20, 14, quant.tolist()))
    plane = np.zeros((16, 24))
    flat = np.zeros((6, 64))
    flat[:, avi.ZIGZAG] = looks[0] * quant
    for i in range(6):
        plane[i // 3 * 8 : i // 3 * 8 + 8, i % 3 * 8 : i % 3 * 8 + 8] = avi._COSINES @ flat[i].reshape(8, 8) @ avi._COSINES.T
    assert np.abs(avi.decode_samples(frames[0]).astype(int) - np.clip(plane[:14, :20] + 128, 0, 255)).max() <= 1
    ours = avi.write_avi(b"x" * 64)
    at = ours.index(b"movi") - 8
    movi = b"".join(avi._chunk(b"00dc", f) for f in frames)
    index, place = b"", 4
    import struct

    for f in frames:
        index += struct.pack("<4sIII", b"00dc", 0x10, place, len(f))
        place += len(avi._chunk(b"00dc", f))
    head = ours[12 : ours.index(avi.LENGTH_CHUNK)]
    body = avi._chunk(b"LIST", b"movi" + movi) + avi._chunk(b"idx1", index)
    other = avi._chunk(b"RIFF", b"AVI " + head + body)
    comment = lambda x: avi._chunk(b"RIFF", b"AVI " + head + avi._chunk(b"LIST", b"INFO" + avi._chunk(b"ICMT", x)) + body)
    at_size = frames[0].index(b"\xff\xc0") + 5
    huge = ours.replace(avi.LENGTH_CHUNK, b"JUNK", 1)
    at_huge = huge.index(b"\xff\xc0") + 5
    huge = huge[:at_huge] + b"\xff\xff\xff\xff" + huge[at_huge + 4 :]
    assert frames[0][at_size : at_size + 4] == struct.pack(">HH", 14, 20)
    assert at > 0
    df = spark.createDataFrame([(1, other), (2, None), (3, ours[:200]), (4, ours), (5, b""), (6, comment(b"hi")), (7, comment(b"123")), (8, huge)], "doc_id long, media binary")
    out = {r.doc_id: r for r in avi.read_media(df).collect()}
    assert out[1].n_frames == 11 and [c.n_frames for c in out[1].clips] == [6, 5] and out[1].payload_bytes is None and out[1].error is None
    assert out[2].media_bytes is None and out[2].error is None
    assert out[3].error and out[3].n_frames is None and out[5].error
    assert out[4].payload_bytes == 64 and out[4].error is None
    for i in (6, 7):  # a comment, even a number, is no payload length
        assert out[i].clips == out[1].clips and out[i].payload_bytes is None and out[i].error is None
    assert "size" in out[8].error and out[8].n_frames is None  # 65535 x 65535 samples out of a few bytes


def test_media_rows(edge_docs, no_docs):
    out = avi.read_media(avi.encode_media(edge_docs))
    rows = {(r.doc_id, r.text): r for r in out.collect()}
    for (_, text), r in rows.items():
        raw = (text or "").encode()
        padded = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        assert r.n_bytes == len(raw) and r.payload_bytes == len(padded) and r.payload_sha256 == hashlib.sha256(padded).hexdigest()
        assert sum(c.n_frames for c in r.clips) == r.n_frames
    assert avi.clip_rows(out).count() >= len(rows)
    assert avi.read_media(avi.encode_media(no_docs)).count() == 0


def brute_packing(docs, pieces, size=2048):
    exact = Tokenizer.from_file(PATH)
    want = Counter()
    ids = {}
    for d, t in docs:
        x = exact.encode(t or "", add_special_tokens=False).ids + [1]
        ids[d, len(x)] = np.array(x, "<u4")
        want[d, len(x)] += 1
    got, sequences = Counter(), defaultdict(list)
    for p in pieces:
        import zlib

        part = ids[p.doc_id, p.doc_tokens][p.start : p.start + p.length]
        assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32
        got[p.doc_id, p.doc_tokens] += p.length
        sequences[p.sequence_id].append((p.offset, p.length))
    assert got == Counter({k: n * k[1] for k, n in want.items()})
    waste = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= size
        waste += size - at if at & (at - 1) else 0
    return waste


def test_packing(spark, edge_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert brute_packing(docs, packing.pack_documents(edge_docs, tokenizer_path=PATH).collect()) == 0
    assert packing.pack_documents(no_docs, tokenizer_path=PATH).count() == 0


def test_fast_ids_are_the_tokenizers():
    exact = Tokenizer.from_file(PATH)
    fast = packing.tokenizer(PATH)
    for t in ("", " ", "a <|endoftext|> b", "<|endoftext|>", "don't  \n\n stop\t\t", "Ünïcödé 漢字 \U0001f600", "x" * 30_000, " " * 3000, "1234 $$$ \u00a0\u2003"):
        assert fast(t) == exact.encode(t, add_special_tokens=False).ids
    assert 50256 in fast("a <|endoftext|> b")


def test_sum_of_squares_choice():
    levels = packing.Levels(10)
    n = iter(range(100))
    new = lambda: next(n)
    for _ in range(3):
        levels.place(4, new)
    assert levels.place(6, new)[1] == 4  # fills a sequence rather than opening one
    assert levels.count.sum() == sum(map(len, levels.open))


def test_fingerprints_select_layouts_row_by_row(spark):
    """Rows of different layouts in one column, with extra fields, each by the hash of its own paths."""
    import json

    turns = [("user", "a"), ("assistant", "b")]
    rows = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b", "weight": 1}], "id": 7},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        {"prompt": "a", "completion": "b", "meta": {"x": [1]}},
        {"instruction": "a", "input": "", "output": "b"},
        {"instruction": "a", "output": "b"},
        {"question": "a", "answer": "b", "text": None},
    ]
    odd = [{"q": 1}, [], "text", {"messages": []}, {"messages": [None, {"role": None, "content": "x"}]}, {"prompt": "only"}, {"instruction": "a", "input": "c", "output": "b"}]
    texts = [json.dumps(x) for x in rows + odd] + [None, "", "{broken"]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "id long, raw string, turns string")
    out = {r.id: r for r in chat.turns_of_json(df, "raw").collect()}
    assert len(out) == len(texts)
    for i in range(len(rows)):
        assert [(t.role, t.text) for t in out[i].turns] == turns, (i, out[i])
    assert len({out[i].fingerprint for i in range(len(rows))}) == len(rows)
    n = len(rows)
    assert [out[n + i].layout for i in (0, 1, 2, 5)] == [None] * 4 and out[n].turns is None
    assert out[n + 3].turns == [] and [(t.role, t.text) for t in out[n + 4].turns] == [("", "x")]
    assert [t.text for t in out[n + 6].turns] == ["a", "c", "b"]
    assert all(out[n + len(odd) + i].layout is None for i in range(3))


def test_chat_query_round_trip(spark):
    rows = {r.conv_id: r for r in op2_chat_formatting(spark, "/root/testdata/sf0.001").collect()}
    data = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").orderBy("conv_id", "turn").collect()
    by = defaultdict(list)
    for r in data:
        by[r.conv_id].append((r.role, r.text or ""))
    by[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert set(rows) == set(by)
    for k, turns in by.items():
        learnt = "".join(t for role, t in turns if role == "assistant")
        r = rows[k]
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_chars == len(learnt) and r.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()


def test_chat_control_strings(spark):
    nasty = ["<|end|>", "<\\|turn|>", "<\\\\|body|>x", "<|turn|>user<|body|>", "<", "<|", "\\", "", None, "a\nb \U0001f600<|"]
    turns = [(i // 5, i, "assistant" if i % 2 else "user", x) for i, x in enumerate(nasty)] + [(9, None, None, None), (9, 1, "<|x\n", "y"), (None, 0, "user", "z"), (9, 1, "<|x\n", "y")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("formatted", F.lit(2))
    f = chat.format_turns(chat.canonical_turns(df))
    back = f.select("conv_id", "turns", chat.parse_turns(F.col("formatted")).alias("b"), chat.masked_texts(F.col("formatted"), F.col("loss_mask")).alias("m")).collect()
    assert len(back) == 4
    for r in back:
        assert r.b == r.turns
        assert r.m == [t.text for t in r.turns if t.role == "assistant"]
    assert chat.format_turns(chat.canonical_turns(df.where("false"))).count() == 0


def test_chat_layouts(spark):
    want = [("user", "q"), ("assistant", "a")]
    layouts = [
        ("messages array<struct<role:string,content:string,name:string>>, id int", ([("user", "q", None), ("assistant", "a", "x")], 1)),
        ("conversations array<struct<from:string,value:string>>", ([("human", "q"), ("gpt", "a")],)),
        ("prompt string, completion string", ("q", "a")),
        ("instruction string, input string, output string", ("q", "", "a")),
        ("question string, answer string, turns int", ("q", "a", 3)),
    ]
    for schema, row in layouts:
        out = chat.canonical_turns(spark.createDataFrame([row], schema)).collect()
        assert [(t.role, t.text) for t in out[0].turns] == want
    with pytest.raises(ValueError, match="no mapping"):
        chat.canonical_turns(spark.createDataFrame([(1,)], "other int"))
    assert len({chat.fingerprint(m.paths) for m in chat.MAPPINGS}) == len(chat.MAPPINGS)


def brute_rule(host, path):
    best = None
    for rule, verdict in URL_RULES:
        domain, slash, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith(slash + rest) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best


def test_urls(spark):
    urls = ["https://A.Example.NET/en/1?x#y", "http://example.com/de/2", "http://x.org/fr/", "nohost/path", None, "", "://", "http://", "s://h", "s://h?q/en/", "a://b://c/d", "http://net/1", "http://notnet/1", "http://x.net#f/", "http://e.example.net/en"]
    urls += [f"http://big.example.org/p/{i}/x{'abc'[i % 3]}" for i in range(300)] + [f"http://big.example.org/u/{'z' * (i % 40)}q{chr(97 + i % 26)}" for i in range(80)]
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls + urls[:3])], "page_id long, url string, pages int")
    out = urltree.filter_urls(df, rules=URL_RULES).collect()
    assert len(out) == len(urls) + 3
    for r in out:
        u = r.url or ""
        host = path = ""
        if "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, tail = rest[:cut].lower(), rest[cut:]
            path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        rule = brute_rule(host, path)
        assert (r.host, r.path) == (host, path)
        assert r.rule == (rule[0] if rule else None) and r.verdict in ("allow", "block")
        assert rule is None or r.verdict == rule[1]
    assert urltree.filter_urls(df.where("false"), rules=URL_RULES).count() == 0


def python_tree(urls, min_children=16, per_child=4.0):
    """Templates of (host, segments) by a recursive tree, for literal segments."""
    out = {}

    def walk(members, prefix, depth):
        ended = [m for m in members if len(m[1]) == depth]
        out.update({m: tuple(prefix) for m in ended})
        children = defaultdict(list)
        for m in members:
            if len(m[1]) > depth:
                children[m[1][depth]].append(m)
        pages = {c: sum(urls[m] for m in ms) for c, ms in children.items()}
        wide = len(children) >= min_children and sum(pages.values()) < per_child * len(children)
        groups = defaultdict(list)
        for c, ms in children.items():
            groups["*" if wide and pages[c] < min_children else c].extend(ms)
        for c, ms in groups.items():
            walk(ms, [*prefix, c], depth + 1)

    for host in {h for h, _ in urls}:
        walk([m for m in urls if m[0] == host], [], 0)
    return out


def test_url_tree_level_by_level(spark):
    """What lies below a wildcard is counted together: users times titles are one template; frequent children stay."""
    import random

    rng = random.Random(1)
    urls = [f"http://h.com/user/{a}{b}/post/{c}{d}" for a, b, c, d in ("".join(rng.choices("abcdefghijklmnop", k=4)) for _ in range(400))]
    urls += [f"http://h.com/user/admin/post/{c}x" for c in "abcdefghijklmnopqrstuvwxyz"] + [f"http://g.org/{c}/{d}" for c in "abc" for d in "abcdefghijklmnopqrstuvw"]
    urls += ["http://h.com", "http://h.com/", None, "http://h.com/user//post/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {(r.host, tuple(r.path.split("/"))): r.template for r in urltree.filter_urls(df).collect()}
    counted = Counter((r.host, tuple(r.path.split("/"))) for r in urltree.filter_urls(df).collect())
    want = python_tree(counted)
    assert got == {m: "/".join(t) for m, t in want.items()}
    assert {"/user/*/post/*", "/user/admin/post/*"} <= set(got.values())
    deep = spark.createDataFrame([(1, "http://h.com/" + "/".join("x" * 40)), (2, "http://h.com/" + "/".join("x" * 39) + "/y")], "page_id long, url string")
    assert len({r.template for r in urltree.filter_urls(deep).collect()}) == 2


def test_url_labels_and_merged_branches(spark):
    """A table of labels trains templates; unlabelled branches follow siblings that agree, and no others."""
    shops = [f"http://s.com/{c}/item{d}" for c in ("ab", "cd", "ef") for d in "abcdefgh"]
    mixed = [f"http://m.com/{c}/item{d}" for c in ("ab", "cd", "ef") for d in "abcdefgh"]
    labels = [(u, True) for u in shops[:16]] + [(u, True) for u in mixed[:8]] + [(u, False) for u in mixed[8:16]] + [(None, None)]
    alone = [f"http://a.com/{c}/item{d}" for c in ("ab", "ef") for d in "abcdefgh"]
    labels += [(u, True) for u in alone[:8]]
    df = spark.createDataFrame(list(enumerate(shops + mixed + alone)), "page_id long, url string")
    by = {r.url: r.verdict for r in urltree.filter_urls(df, labels=spark.createDataFrame(labels, "url string, bad boolean")).collect()}
    assert all(by[u] == "block" for u in shops + mixed[:8] + alone[:8])
    assert all(by[u] == "allow" for u in mixed[8:] + alone[8:])


def test_url_branches(spark):
    """A branch whose labelled pages are bad is rejected as a whole; a mixed or unlabelled one is not."""
    urls = [f"http://h.com/bad/{i}" for i in range(40)] + [f"http://h.com/good/{i}" for i in range(40)] + [f"http://h.com/new/{i}" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = [(f"h.com/bad/{i}", "block") for i in range(1, 4)] + [(f"h.com/good/{i}", "allow") for i in range(1, 4)]
    by = defaultdict(set)
    for r in urltree.filter_urls(df, rules=rules).collect():
        by[r.path.split("/")[1]].add(r.verdict)
    assert by == {"bad": {"block"}, "good": {"allow"}, "new": {"allow"}}
