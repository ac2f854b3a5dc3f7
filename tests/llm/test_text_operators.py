"""SentencePiece encoding, lexical search and token alignment against the library and brute force."""

import bisect
import collections
import hashlib
import math
import random
import re
from array import array

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_operators import DOCS, ODD, _docs
from tokenizers import Tokenizer

from heliolake.llm import lexical_search, piece_encoder, queries, token_alignment
from heliolake.llm.shared import table

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
EXTRA = ["a▁b", "<s> <0x41> <unk> <|endoftext|>", "x" + " " * 300 + "y", "\x00\r\n\t", "ﬁ Ａ​﻿",
         "中文" * 3000, "ab" * 20_000, "  lead and trail  ", "1234567890 12 1", "A-Z_9 É é ñandú"]
LETTERS = st.text(st.one_of(st.sampled_from("aeinst  \n▁.'0"), st.characters(codec="utf-8")), max_size=60)


@pytest.fixture(scope="module")
def odd(spark):
    return _docs(spark, ODD + [(100 + i, t) for i, t in enumerate(EXTRA)]).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def pieces():
    return piece_encoder.PieceTable(MODEL)


# -- 11 SentencePiece --------------------------------------------------------------------

def test_encoding_equals_the_library(pieces, spark):
    library = pieces.model
    texts = [r.text or "" for r in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    texts += [t for t in ODD if isinstance(t, str)] + EXTRA
    texts += ["x" * (k % 3) + " " * k + "yé\n"[k % 4:] for k in range(1, 120)]
    for text in texts:
        assert pieces.encode(text) == library.encode(text), text[:80]


@settings(max_examples=400, deadline=None)
@given(LETTERS)
def test_encoding_of_any_text(text):
    pieces = piece_encoder.piece_table(MODEL)
    ids = pieces.encode(text)
    assert ids == pieces.model.encode(text)
    assert pieces.decode(ids) == pieces.model.decode(ids)


def test_pieces_encode_to_themselves(pieces):
    """Each piece, set between characters no piece joins with, keeps its id; its parts' ranks are
    lower than its own."""
    for i in range(0, len(pieces.rank), 7):
        if pieces.rank[i] >= 0:
            left, right = pieces.parts[i]
            assert max(pieces.rank[left], pieces.rank[right]) < pieces.rank[i]
            assert pieces._encode_segment(pieces.model.id_to_piece(i)) == [i]


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(piece_encoder, "MEMO", 10)
    small = piece_encoder.PieceTable(MODEL)
    for k in range(100):
        assert small.encode(f"w{k} again") == small.model.encode(f"w{k} again")
    assert len(small.memo) <= 10 and len(small.older) <= 10


def test_segments_take_few_steps():
    """A segment not met before is looked up about once a token, not at every character; what is
    remembered is packed ids of short segments."""
    table = piece_encoder.PieceTable(MODEL)
    rng, seen, steps = random.Random(11), [], []
    parts = ["tion", "ent", "heit", "schen", "ación", "elle", "re", "an", "th", "ou", "ß", "✈", "$$$"]
    words = list({"".join(rng.choices(parts, k=rng.randint(2, 5))) for _ in range(3000)})

    class Trie:
        def longest_prefix(self, text):
            steps.append(text)
            return trie.longest_prefix(text)
    trie = table.trie
    table.trie = Trie()
    for word in words:
        ids = table.encode(word)
        assert ids == table.model.encode(word)
        seen += ids
    assert len(steps) < 2 * len(seen) and len(steps) < 0.7 * sum(len(w) + 1 for w in words)
    before = len(steps)
    assert array("i", table.encode_packed(" ".join(words))).tolist() == table.model.encode(" ".join(words))
    assert len(steps) == before
    assert all(isinstance(ids, bytes) and len(s) <= piece_encoder.SHORT for s, ids in table.memo.items())


def test_segments_are_cut_alike_by_split_and_by_pattern(pieces):
    """Texts with runs of marks or with U+0000 are cut by the pattern, others by splitting."""
    rng = random.Random(12)
    for space in (" ", "  ", "\0", " ▁"):
        for _ in range(300):
            text = "".join(rng.choices(["a", "Haus", "\n", "\n\n", space, " ", "é", "✈", "the", "ing"], k=12))
            assert pieces.encode(text) == pieces.model.encode(text)
            assert pieces.decode(pieces.encode(text)) == pieces.model.decode(pieces.model.encode(text))


def test_models_that_do_not_fit_are_refused(monkeypatch, pieces):
    class Other:
        def __init__(self, **_):
            pass

        def __getattr__(self, name):
            return getattr(pieces.model, name)

        def is_unused(self, i):
            return i == 5
    monkeypatch.setattr("sentencepiece.SentencePieceProcessor", Other)
    with pytest.raises(ValueError):
        piece_encoder.PieceTable(MODEL)


def test_encode_documents(spark, odd, none, pieces):
    got = piece_encoder.encode_pieces(odd, MODEL).collect()
    want = [(r.doc_id, pieces.model.encode(r.text or "")) for r in odd.collect()]
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == sorted((str(d), i) for d, i in want)
    assert all(r.decoded == pieces.model.decode(list(r.ids)) for r in got)
    assert piece_encoder.encode_pieces(none, MODEL).collect() == []
    docs = table(spark, SF, "documents")
    by = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in queries.op11_sentencepiece(spark, SF).collect():
        ids = pieces.model.encode(by[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(pieces.model.decode(ids).encode()).hexdigest()


# -- 12 lexical search -------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _search(docs, items, k):
    """(item, rank, doc, score) by scoring every document."""
    bags = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    n_docs, total = sum(1 for _, b in bags if b), sum(len(b) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in set(b))
    out = []
    for item, text in items:
        asked, found = set(TERM.findall((text or "").translate(LOWER))), []
        for d, b in bags:
            m = 100 - 50 + (50 * len(b) * n_docs) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10 ** 9 * b.count(t)) // (1000 * b.count(t) + 20 * m))
                        for t in asked & set(b))
            if score > 0:
                found.append((-score, d is None, d))
        found.sort()
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


ITEMS = "item_id long, text string, doc_id string, n long"


def test_search_equals_brute_force(spark, odd, none, monkeypatch):
    items = [(1, "Seven words, and WORD13 id here!"), (2, None), (3, ""), (4, "-- !?"), (5, "zzz unknown"),
             (6, "tëxt öf wörds é ñandú word1 word2 word3"), (6, "a b c d e f line one"), (None, "text words"),
             (7, " ".join(f"word{i}" for i in range(900)))]
    asked = spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS)
    plain = [(r.doc_id, r.text) for r in odd.collect()]
    for k in (3, 50):
        got = lexical_search.search_documents(odd, asked, k).collect()
        assert sorted(map(tuple, got), key=str) == _search(plain, items, k)
    monkeypatch.setattr(lexical_search, "PASS_TERMS", 5)  # a pass per item or two
    monkeypatch.setattr(lexical_search, "SEED_SHARDS", 1)
    got = lexical_search.search_documents(odd, asked, 3).collect()
    assert sorted(map(tuple, got), key=str) == _search(plain, items, 3)
    assert lexical_search.search_documents(none, asked).collect() == []
    assert lexical_search.search_documents(odd, asked.limit(0)).collect() == []


def _shard(monkeypatch, rng, n_docs=300, vocabulary=40, width=4096):
    for name, value in (("BLOCK", 8), ("LEAST", 3), ("WIDTH", width)):
        monkeypatch.setattr(lexical_search, name, value)
    asked = lexical_search.Queries()
    for q in range(12):
        terms = rng.sample(range(vocabulary), rng.randint(1, 9))
        asked.add(q, q, [(f"t{t}", 5000 // (t + 1)) for t in sorted(terms)])
    size = len(asked.weight)
    docs, cut, term, impact = [], [0], [], []
    for d in range(n_docs):
        group = d % 5  # documents of a group are alike
        held = sorted({int(rng.triangular(0, size, group * size / 5)) for _ in range(rng.randint(1, 12))})
        term += held
        impact += [rng.randint(1, 999_999) // (1 + (t + group) % 4) for t in held]
        cut.append(len(term))
        docs.append(rng.choice([d, d, d // 2, None]))
    arrays = [np.array(x, np.int64) for x in (cut, term, impact)]
    parts = lexical_search.build_shard(docs, *arrays, asked.partners(), np.array(asked.weight, np.int64))
    row = {c: parts[c].astype(kind).tobytes() for c, kind in lexical_search._TYPES.items()}
    return asked, lexical_search.Shard(row | {"docs": docs}, asked), arrays, docs


@pytest.mark.parametrize("width", [4096, 3])
def test_blocks_lose_no_document(monkeypatch, width):
    rng = random.Random(width)
    asked, shard, (cut, term, impact), docs = _shard(monkeypatch, rng, width=width)
    weight, partners, opened = np.array(asked.weight, np.int64), asked.partners(), []
    real = shard.open
    shard.open = lambda k, *a: opened.append((len(shard.list(k)), len(r := real(k, *a)))) or r
    for terms in asked.terms:
        w = dict(zip(terms.tolist(), weight[terms].tolist(), strict=True))
        score = [sum(w.get(t, 0) * x for t, x in zip(term[a:b].tolist(), impact[a:b].tolist(), strict=True))
                 for a, b in zip(cut[:-1], cut[1:], strict=True)]
        ranked = sorted(range(len(docs)), key=lambda d: (-score[d], docs[d] is None, docs[d] or 0))
        for k in (1, 10, 1000):
            for needed in (0, score[ranked[9]], score[ranked[0]], score[ranked[0]] + 1):
                place, got = shard.best(terms, weight[terms], partners, k, needed)
                want = [d for d in ranked if score[d] >= max(needed, 1)][:k]
                assert got.tolist() == [score[d] for d in want]
                assert [docs[d] for d in place.tolist()] == [docs[d] for d in want]
                assert all(score[d] == s for d, s in zip(place.tolist(), got.tolist(), strict=True))
    if width > 100:
        assert any(after < before for before, after in opened)  # blocks are skipped


def test_summaries_are_maxima(monkeypatch):
    asked, shard, (cut, term, impact), _ = _shard(monkeypatch, random.Random(5))
    partners = asked.partners()
    for k, t in enumerate(shard.list_term.tolist()):
        rows, low, high = shard.list(k), shard.list_blocks[k], shard.list_blocks[k + 1]
        assert set(rows.tolist()) == {d for d in range(len(cut) - 1) if t in term[cut[d]:cut[d + 1]]}
        if low == high:
            assert len(rows) < 3
            continue
        starts = shard.block_cut[low:high].tolist() + [len(rows)]
        assert starts[0] == 0 and all(0 < b - a <= 8 for a, b in zip(starts, starts[1:]))
        summary = shard.summary[shard.summary_cut[k]:shard.summary_cut[k + 1]].reshape(high - low, -1)
        for block, (a, b) in enumerate(zip(starts, starts[1:])):
            held = [dict(zip(term[cut[d]:cut[d + 1]].tolist(), impact[cut[d]:cut[d + 1]].tolist(),
                             strict=True)) for d in rows[a:b].tolist()]
            want = [max(h.get(p, 0) for h in held) for p in partners[t].tolist()]
            assert summary[block].tolist() == want


# -- 13 token alignment ------------------------------------------------------------------

@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([1, 1, 1, 2, 3]), min_size=1, max_size=80),
       st.lists(st.sampled_from([1, 1, 1, 2, 3]), min_size=1, max_size=80))
def test_alignment_of_any_ends(a, b):
    a, b = list(np.cumsum(a)), list(np.cumsum(b))
    end = int(max(a[-1], b[-1])) + 1
    a, b = [int(x) for x in a] + [end], [int(x) for x in b] + [end]
    groups = []
    for i, i_stop, j, j_stop in token_alignment.align(a, b):
        if a[i] == b[j]:
            assert i_stop - i == j_stop - j
            groups += [((x,), (y,)) for x, y in zip(range(i, i_stop), range(j, j_stop), strict=True)]
        else:
            groups.append((tuple(range(i, i_stop)), tuple(range(j, j_stop))))
    want, i, j = [], 0, 0
    for cut in sorted(set(a) & set(b)):
        p, q = bisect.bisect_right(a, cut), bisect.bisect_right(b, cut)
        want.append((tuple(range(i, p)), tuple(range(j, q))))
        i, j = p, q
    assert groups == want


def test_long_stretches_are_jumped():
    class Counted(list):
        reads = 0

        def __getitem__(self, k):
            Counted.reads += 1
            return list.__getitem__(self, k)
    ends = Counted(range(1, 100_001))
    assert list(token_alignment.align(ends, list(range(1, 100_001)))) == [(0, 100_000, 0, 100_000)]
    assert Counted.reads < 100


def test_units_in_use_are_learned_once(monkeypatch):
    monkeypatch.setattr(token_alignment, "MEMO", 60)
    pair = token_alignment.TokenPair(queries.TOKENIZER, queries.PATTERN, MODEL)
    learned, learn = collections.Counter(), pair._learn
    pair._learn = lambda units: learned.update(units) or learn(units)
    texts = [f"usual words x{k}y x{k}z end" for k in range(200)]
    got = [pair.aligned(t)[:4] for t in texts]
    assert learned["words"] == learned["end"] == 1 and learned["x7y"] == 1
    assert max(len(pair.memo), len(pair.older)) <= 60
    assert got == [x[:4] for x in _aligned(texts)]


def test_links_of_irregular_groups():
    pair = token_alignment.token_pair(queries.TOKENIZER, queries.PATTERN, MODEL)
    texts = ["Donaudampfschifffahrtsgesellschaft épées 1234567890 naïveté", "ñ", "中文字 aé\n\n\tb  c",
             "xqzjkv wvutsrq zyxw, Überraschungsgäste"]
    for text, want in zip(texts, _aligned(texts), strict=True):
        *head, links = pair.aligned(text)
        assert (head, len(links)) == (list(want[:4]), len(want[4]))
        linked = [(int(p) // token_alignment.PAIR, int(p) % token_alignment.PAIR) for p in links]
        assert collections.Counter(linked) == collections.Counter(want[4])


def _aligned(texts):
    """Per text: tokens of A and B, groups, links, by comparing all byte ranges."""
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = piece_encoder.piece_table(MODEL).model
    pair = token_alignment.TokenPair(queries.TOKENIZER, queries.PATTERN, MODEL)

    def ranges(sizes):
        ends = np.cumsum(sizes).tolist()
        return list(zip([0, *ends[:-1]], ends, strict=True))
    for text in texts:
        raw = (" " + text).encode() if text else b""
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text or "")
        spelt = [b"".join(t[i] for i in ids) for t, ids in ((pair.bytes_a, a), (pair.bytes_b, b))]
        if not text or any(s != raw for s in spelt):
            yield 0, 0, 0, "", []
            continue
        ra, rb = (ranges([len(t[i]) for i in ids]) for t, ids in ((pair.bytes_a, a), (pair.bytes_b, b)))
        starts, links = [s for s, _ in rb], []
        for i, (low, high) in enumerate(ra):
            j = bisect.bisect_right(starts, low) - 1
            while j < len(rb) and rb[j][0] < high:
                links.append((a[i], b[j]))
                j += 1
        cuts, groups, i, j = sorted({e for _, e in ra} & {e for _, e in rb}), [], 0, 0
        for cut in cuts:
            p = next((k for k in range(i, len(ra)) if ra[k][1] > cut), len(ra))
            q = next((k for k in range(j, len(rb)) if rb[k][1] > cut), len(rb))
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        yield len(a), len(b), len(groups), ";".join(groups), links


def _linked(texts):
    found = list(_aligned(texts))
    counts = collections.Counter(p for f in found for p in set(f[4]))
    best = collections.defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    for n_a, n_b, n_groups, groups, links in found:
        yield (n_a, n_b, n_groups, len(links), sum(counts[p] == best[p[0]] for p in links),
               sum(counts[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if n_a else "")


def _link_counts(docs):
    from pyspark.sql import functions as F
    aligned = token_alignment.align_documents(docs, queries.TOKENIZER, queries.PATTERN, MODEL)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return token_alignment.link_counts(aligned.withColumn("groups_sha256", digest).drop("groups"))


def test_alignment_equals_brute_force(spark, odd, none):
    rows = odd.collect()
    got = _link_counts(odd).collect()
    cols = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    want = [(r.doc_id, *x) for r, x in zip(rows, _linked([r.text for r in rows]), strict=True)]
    assert sorted(((r.doc_id, *(r[c] for c in cols)) for r in got), key=str) == sorted(want, key=str)
    assert _link_counts(none).collect() == []


def test_alignment_query(spark):
    docs = table(spark, SF, "documents").collect()
    got = {r.doc_id: r for r in queries.op13_token_alignment(spark, SF).collect()}
    for d, x in zip(docs, _linked([d.text for d in docs]), strict=True):
        r = got[d.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == x


@settings(max_examples=150, deadline=None)
@given(LETTERS)
def test_groups_of_any_text(text):
    pair = token_alignment.token_pair(queries.TOKENIZER, queries.PATTERN, MODEL)
    n_a, n_b, n_groups, groups, links = pair.aligned(text)
    want = next(iter(_aligned([text])))
    linked = [(int(p) // token_alignment.PAIR, int(p) % token_alignment.PAIR) for p in links]
    assert (n_a, n_b, n_groups, groups, sorted(linked)) == (*want[:4], sorted(want[4]))


def test_block_lists(spark):
    """Blocks name their pairs once, with the number of their documents that hold each."""
    rows = [(k, 1, 1, 1, "g", np.array(x, np.int64)) for k, x in enumerate([[5, 5, 9], [], [9], [9, 5, 7]])]
    batch = token_alignment._block(3, rows)
    first = batch.slice(0, 1).to_pylist()[0]
    assert first["pairs"] == [5, 7, 9] and first["pair_docs"] == [2, 1, 3]
    got = [(np.frombuffer(r["pair_at"], "<u4").tolist(), np.frombuffer(r["times"], "<u4").tolist())
           for r in batch.to_pylist()]
    assert got == [([0, 2], [2, 1]), ([], []), ([2], [1]), ([0, 1, 2], [1, 1, 1])]
