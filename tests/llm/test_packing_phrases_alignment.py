"""Packing, phrase mining and token alignment against brute force on small fixtures."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import collocations, packing, queries, token_align, token_store
from tests.llm.test_operators import DOCS, lower, rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def whole_ids(texts: list[str | None], end: int) -> list[list[int]]:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_file())
    return [e.ids + [end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


AWKWARD = ["", " ", "<|endoftext|>", "<|EndOfText|> x", "Hello,world. \"ok\". don't, it'S.", "É. é. x²,", "日本語。,", "३. ௧,", "İstanbul. STRASSE ẞ. ﬁ.",
           "a|b.", "...", "..a..", " x y", "ẛ̣. K", "ſ ﬀ Ǆ", "á. éb", "x\x00y. \x7f", "don't't's.'s,", "Straße, groß! 12,5% #a&b;"]


def test_encoder_equals_whole_texts():
    import pyarrow as pa

    texts = AWKWARD + [r[1] for r in rows()]
    enc = token_store.Encoder(queries.tokenizer_file())
    for _ in range(2):  # the second time from the cache
        ids, count = enc.texts(pa.array(texts, pa.string()), False, 7)
        ends = np.cumsum(count)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, count)] == whole_ids(texts, 7)


def test_token_files_crc_is_zlib_of_the_ids(spark, docs, tmp_path):
    got = queries.encoded(docs, str(tmp_path / "t")).collect()
    want = Counter((r[0], len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for r, i in zip(rows(), whole_ids([r[1] for r in rows()], 1)))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want


def test_packing(docs):
    window, shard = 64, 4
    got = packing.pack_documents(docs, queries.tokenizer_file(), window=window, shard_windows=shard, slack=3).collect()
    data = rows()
    ids = whole_ids([r[1] for r in data], 2)
    # every document's ids, whole and once: pieces of equal rows are told apart by their places
    want, pieces = Counter(), Counter()
    for r, x in zip(data, ids):
        for i, v in enumerate(x):
            want[(r[0], len(x), i, v)] += 1
    for p in got:
        for i, v in enumerate(np.frombuffer(p.ids, "<u4").tolist()):
            pieces[(p.doc_id, p.doc_tokens, p.start + i, v)] += 1
        assert len(p.ids) == 4 * p.length
    assert pieces == want
    by_sequence = defaultdict(list)
    for p in got:
        by_sequence[p.sequence_id].append(p)
    total = sum(map(len, ids))
    assert sorted(by_sequence) == list(range(-(-total // window)))
    for k, members in by_sequence.items():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == (window if k < total // window else total % window)
    # each shard serves what is due to the token; each window is near target, what it lacks or owes carries over
    size = Counter()
    for r, x in zip(data, ids):
        size[r[3]] += len(x)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    served = Counter()
    for k in range(total // window):
        for p in by_sequence[k]:
            served[p.source_queue] += p.length
        for q, s in enumerate(order):
            due = (k + 1) * window * size[s] / total
            assert abs(served[q] - due) <= (1.001 if (k + 1) % shard == 0 else 3 + 3 * len(order)), (k, s)


def test_packing_weights_decide(docs):
    weights = {"a": 5, "b": 1, "c": 1, "Z": 1, None: 1}
    got = packing.pack_documents(docs, queries.tokenizer_file(), weights, window=90, shard_windows=3, slack=0).collect()
    first = Counter()
    for p in got:
        if p.sequence_id < 6:
            first[p.source_queue] += p.length
    assert [first[q] for q in range(5)] == [60, 300, 60, 60, 60]  # Z, a, b, c, null
    assert sum(p.length for p in got) == sum(map(len, whole_ids([r[1] for r in rows()], 2)))


def test_packing_rank_is_due_order():
    r = random.Random(1)
    for _ in range(20):
        size = [r.randint(1, 30) for _ in range(r.randint(1, 5))]
        weight = list(size) if r.random() < 0.5 else [r.randint(1, 9) for _ in size]
        due = sorted(((2 * x + 1) / weight[q], q, x) for q, n in enumerate(size) for x in range(n))
        for place, (_, q, x) in enumerate(due):
            exact = packing.rank(q, x, size, weight)
            near = [i for i, d in enumerate(due) if abs(d[0] - due[place][0]) < 1e-9]
            assert exact in near
        assert sorted(packing.rank(q, x, size, weight) for _, q, x in due) == list(range(len(due)))
        shards = packing.Shards(size, weight, 7)
        for q, n in enumerate(size):
            for k, lo, hi in shards.cuts(q, 0, n):
                assert all(packing.rank(q, x, size, weight) // 7 == k for x in range(lo, hi))


def test_packing_many_sources_share_queues(spark, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 3)
    d = spark.createDataFrame([(i, "one two three", f"s{i % 11}") for i in range(40)], "doc_id long, text string, source string")
    got = packing.pack_documents(d, queries.tokenizer_file(), window=16, shard_windows=2).collect()
    assert max(p.source_queue for p in got) <= 2 and sum(p.length for p in got) == 160


def test_empty_tables(empty):
    assert packing.pack_documents(empty, queries.tokenizer_file()).count() == 0
    assert collocations.collocations(empty).count() == 0
    files = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("piece_bpe_32k.model")
    assert token_align.align(empty, *files)[0].count() == 0


def brute_collocations(data: list[tuple], top: int, least: int, covered: int) -> set:
    f, n = defaultdict(Counter), Counter()
    for text, lang in data:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i:i + k])] += 1
    out = set()
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {q[i:i + m] for q, b in cand.items() for m in range(2, len(q)) for i in range(len(q) - m + 1) if 100 * b >= covered * c[q[i:i + m]]}
        scored = []
        for p, a in cand.items():
            if p not in gone:
                s, _, l, r = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top]):
            out.add((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return out


def test_collocations(spark):
    r = random.Random(4)
    vocab = ["a", "B", "c", "été", "x", "of", "the"]
    data = [(" ".join(r.choice(vocab) + r.choice(["", "", "", ",", "\n", "\x0c;"]) for _ in range(r.randint(0, 60))), r.choice(["en", None, "und", "fr"]))
            for _ in range(60)]
    data += [(None, "en"), ("", None), ("\t \n", "fr"), ("the quick brown fox. " * 9, "en"), ("New York City, New York City", "en")] * 2
    data.append((" ".join(r.choice(vocab) for _ in range(5000)), "de"))
    d = spark.createDataFrame([(t, lg, 1, "x", 2.0) for t, lg in data], "text string, lang string, n long, word string, code double").repartition(4)
    for top, least, covered in ((2000, 3, 80), (7, 2, 50), (50, 30, 100)):
        got = {tuple(x) for x in collocations.collocations(d, top, least, covered=covered).collect()}
        assert got == brute_collocations(data, top, least, covered)


def test_collocations_deal_packed_phrases(spark, monkeypatch):
    """Phrases of words with and without short names, in many buckets and blocks; distinct phrases are written in no table but the frequent ones'."""
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(12)]
    data = [(" ".join(r.choice(vocab) + r.choice(["", "", ","]) for _ in range(40)), r.choice(["en", "fr", None])) for _ in range(50)]
    kept, write = {}, collocations.materialize
    monkeypatch.setattr(collocations, "materialize", lambda df, name, *codec: kept.setdefault(name, write(df, name, *codec)))
    for name, value in (("BUCKET_ROWS", 100), ("SHORT", 9), ("BLOCK_BYTES", 600)):
        monkeypatch.setattr(collocations, name, value)
    d = spark.createDataFrame(data, "text string, lang string").repartition(3)
    got = {tuple(x) for x in collocations.collocations(d, 2000, 4).collect()}
    assert got == brute_collocations(data, 2000, 4, 80)
    named = {x for r in kept["phrases-2"].collect() for x in (r.w1, r.w2)}
    assert any(0 <= x < 9 for x in named) and any(not 0 <= x < 9 for x in named)
    assert "occurrences-2" not in kept and kept["occurrences-3"].count() > 3


def brute_alignment(texts: list[str | None]) -> list[tuple]:
    import sentencepiece
    from tokenizers import Tokenizer

    alphabet = token_align.byte_alphabet()
    a = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_file("piece_bpe_32k.model"))
    docs = []
    for t in texts:
        docs.append((0, 0, 0, [], ""))
        e = a.encode(" " + (t or ""), add_special_tokens=False)
        parts_a = [bytes(alphabet[c] for c in x) for x in e.tokens]
        ids_b = b.encode(t or "")
        pieces = [b.id_to_piece(i) for i in ids_b]
        parts_b = [bytes.fromhex(p[3:5]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        raw = (" " + (t or "")).encode()
        if t and b"".join(parts_a) == raw and b"".join(parts_b) == raw:
            ends_a, ends_b = (np.cumsum([len(x) for x in p]).tolist() for p in (parts_a, parts_b))
            starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
            links = [(e.ids[i], ids_b[j]) for i in range(len(ends_a)) for j in range(len(ends_b))
                     if max(starts_a[i], starts_b[j]) < min(ends_a[i], ends_b[j])]
            cuts, groups, lo = sorted(set(ends_a) & set(ends_b)), [], 0
            for c in cuts:
                groups.append("|".join(",".join(str(x) for x, s in zip(ids, starts) if lo <= s < c) for ids, starts in ((e.ids, starts_a), (ids_b, starts_b))))
                lo = c
            docs[-1] = (len(ends_a), len(ends_b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest())
    count = Counter(x for d in docs for x in set(d[3]))
    top: dict[int, int] = defaultdict(int)
    for (x, _), c in count.items():
        top[x] = max(top[x], c)
    return [(d[0], d[1], d[2], len(d[3]), sum(count[x] == top[x[0]] for x in d[3]), sum(count[x] for x in d[3]), d[4]) for d in docs]


def test_alignment(spark):
    odd = ["Hello <|endoftext|> <s> world</s>", "a▁b", "  two  spaces\n\n\nnaïve café — “quotes” 😀👩‍👩‍👧 x", "日本語のテキスト。", " nbsp ​ zero", "ﬁ Ⅳ Å",
           "\x00nul", "tab\tand\r\nline ", "<0x41> <unk>", "supercalifragilisticexpialidocious" * 9, None, "", " ", "the", "the"]
    texts = odd + [r[1] if r[1] is None or len(r[1]) < 1500 else r[1][:1500] for r in rows()]
    data = [(i if i % 9 else None, t, i, "x") for i, t in enumerate(texts)]
    d = spark.createDataFrame(data, "doc_id long, text string, number int, block string").repartition(3)
    files = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("piece_bpe_32k.model")
    want = Counter((r[0], *w) for r, w in zip(data, brute_alignment(texts)))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for lane in (7, 512):
        out, _ = token_align.align(d, *files, lane_bytes=lane)
        assert Counter(tuple(r) for r in out.select(*columns).collect()) == want


def test_alignment_pairs(spark):
    files = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("piece_bpe_32k.model")
    d = spark.createDataFrame([(1, "the cat the cat"), (2, "the dog")], "doc_id long, text string")
    out, pairs = token_align.align(d, *files)
    got = pairs.orderBy(F.desc("count"), "a").collect()
    assert got[0]["count"] == 2 and all(r["count"] == 1 and r["top"] == 1 for r in got[1:])
    assert {r.doc_id: r.count_sum for r in out.collect()} == {1: 6, 2: 3}


def test_filter_misses_no_key(spark):
    from starmart.llm.bloom import in_filter, key_filter

    r = random.Random(9)
    keys = [(r.getrandbits(64) - (1 << 63), r.getrandbits(64) - (1 << 63)) for _ in range(5000)]
    held = key_filter(spark.createDataFrame(keys, "a long, b long"), ["a", "b"])
    assert in_filter(held, np.array(keys, np.int64)).all()
    assert in_filter(held, np.array([(b, a) for a, b in keys], np.int64)).sum() < 5
    assert not in_filter(key_filter(spark.createDataFrame([], "a long"), ["a"]), np.array([[1], [2]], np.int64)).any()
