import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from estrato.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, start long, length long, ids string, n int"
ODD = ["it's 'S ''' isn't we'll 12x3 a1", "<|endoftext|> a<|startoftext|>b <|end", "été ́x É ﬁ İstanbul ΣΑΣ", "a b c\x1cd\x85e", "中文字符日本語 каждый", "\U0001f600\U0001f468‍\U0001f469 x", "", None, " \n ", "x" * 3000, "!?...--,;", "　", "a​b"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def rows_of(rng, many=60):
    words = ["alpha", "Beta", "gamma,", "delta.", "été", "12", "it's"]
    return [(k, " ".join(rng.choices(words, k=rng.choice([1, 5, 60, 300]))), rng.choice(["a", "a", "a", "b", "c", "", None])) for k in range(many)] + [
        (900 + k, t, "odd") for k, t in enumerate(ODD)] + [(None, "no id", "b"), (3, "same id", "b"), (3, "same id", "b"), (2000, "word " * 30_000, "long")]


def table_of(spark, rows, partitions):
    return spark.createDataFrame([(*r, 1, 1, "x", 1) for r in rows], SCHEMA).repartition(partitions)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [packing.END]


def held(pieces, library, rows, window):
    """Every id in one piece, sequences without gaps and full but for the powers of two at the end."""
    seqs = {}
    for p in pieces:
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    want = Counter((d, s, tuple(ids_of(library, t))) for d, t, s in rows)
    got = Counter()
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.source, p.doc_tokens), []).append(p)
    for (d, s, n), own in by_doc.items():
        copies = sum(p.length for p in own) // n
        own.sort(key=lambda p: p.start)
        ids = sum((list(p.ids) for p in own), []) if copies == 1 else None
        got.update([(d, s, tuple(ids))] if copies == 1 else [(d, s, tuple(own[0].ids))] * copies)
        assert copies > 1 or [p.start for p in own] == list(np.cumsum([0] + [p.length for p in own[:-1]]))
    assert got == want
    assert sorted(seqs) == list(range(len(seqs)))
    for number, parts in seqs.items():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts[:-1]]))
        total = sum(n for _, n in parts)
        assert total == window or total < window and total & (total - 1) == 0
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and len(p.ids) == p.length > 0


def brute(library, rows, window, least, shares=None):
    """Deficit round-robin, packet by packet: (doc_id, start, length, sequence, offset) of the pieces of one part."""
    queues, totals = {}, Counter()
    for k, (_, text, source) in enumerate(rows):
        queues.setdefault(source or "", []).append((k, ids_of(library, text)))
        totals[source or ""] += len(queues[source or ""][-1][1])
    tokens = sum(totals.values())
    rest = sum(n for q, n in totals.items() if not shares or q not in shares)
    quantum = {q: n * (window / tokens) if not shares else max(1.0, (shares[q] if q in shares else n * (max(0.0, 1 - sum(shares.values())) / rest)) * window) for q, n in totals.items()}
    packets = {q: [(k, a, min(most, len(ids) - a)) for k, ids in own for a in range(0, len(ids), most)] for q, own in queues.items() for most in [max(least, int(quantum[q]))]}
    sent, stream, turn = Counter(), [], 0
    while any(packets.values()):
        turn += 1
        for q in sorted(packets):
            while packets[q] and (sent[q] + packets[q][0][2]) / quantum[q] <= turn:
                sent[q] += packets[q][0][2]
                stream.append(packets[q].pop(0))
    flat = [(k, a + i) for k, a, n in stream for i in range(n)]
    full, rest = divmod(tokens, window)
    sizes = [window] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    out, at = {}, 0
    for number, size in enumerate(sizes):
        for offset in range(size):
            out[flat[at]] = number, offset
            at += 1
    return out


@pytest.mark.parametrize("window, least, shares", [(64, 16, None), (4096, 128, None), (256, 32, {"a": 0.5, "long": 0.1}), (100, 8, {"c": 0.9})])
def test_same_as_round_robin_packet_by_packet(spark, library, window, least, shares):
    rows = rows_of(random.Random(window))
    pieces = packing.packed(table_of(spark, rows, 1).coalesce(1), PATH, window, shares=shares, least=least).collect()
    held(pieces, library, rows, window)
    order = [(r[0], r[1], r[2]) for r in table_of(spark, rows, 1).coalesce(1).collect()]
    want = brute(library, order, window, least, shares)
    got = Counter((p.sequence_id, p.offset + i, p.doc_id, p.start + i) for p in pieces for i in range(p.length))
    assert got == Counter((number, offset, order[k][0], at) for (k, at), (number, offset) in want.items())


def test_many_parts_and_windows_keep_the_mixture(spark, library):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.choice([20, 100, 400]))), rng.choices("abcd", [6, 3, 2, 1])[0]) for k in range(400)]
    pieces = packing.packed(table_of(spark, rows, 7), PATH, 1024).collect()
    held(pieces, library, rows, 1024)
    total, per = Counter(), {}
    for p in pieces:
        total[p.source] += p.length
        per.setdefault(p.sequence_id, Counter())[p.source] += p.length
    tokens, sent = sum(total.values()), Counter()
    for number in range(tokens // 1024):
        sent.update(per[number])
        for q in total:  # deficits never grow: up to here each source has had its share, but for two quanta and a packet
            share = total[q] / tokens
            assert abs(sent[q] - share * 1024 * (number + 1)) <= 3 * max(128, share * 1024) + 128, (number, q)


def test_sequences_hold_the_ids(spark, library):
    rows = rows_of(random.Random(1), 20)
    pieces = packing.packed(table_of(spark, rows, 3), PATH, 512)
    got = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    assert sum(len(r.ids) for r in got.values()) == sum(len(ids_of(library, t)) for _, t, _ in rows)
    assert all(len(r.ids) in (512, *(1 << k for k in range(9))) for r in got.values())


def test_words_equal_the_library_in_other_tokenizers_too(library):
    tokens = packing.Tokens(open(PATH).read())
    assert tokens.by_word
    rng = random.Random(5)
    alphabet = "aAbéÉ'st! 1٣ ‍中ß\tıİ\U0001f600\x00<|"
    texts = [t or "" for t in ODD] + ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(3000)]
    for _ in range(2):
        ids, sizes = tokens.encode([t.encode() for t in texts], 2)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [ids_of(library, t) for t in texts]
        packing.KEPT_WORDS, kept = 100, packing.KEPT_WORDS
    packing.KEPT_WORDS = kept
    bytewise = public_tokenizers.path("byte_bpe_50k.json")
    assert not packing.falls_into_words(json.load(open(bytewise)))
    other = packing.Tokens(open(bytewise).read())
    ids, sizes = other.encode([b"a b  c", b""], 2)
    assert ids.tolist() == [*Tokenizer.from_file(bytewise).encode("a b  c").ids, 2, 2]


def test_empty(spark):
    assert packing.packed(table_of(spark, [], 1), PATH).count() == 0


def test_query(spark, library):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11_packing(spark, "/root/testdata/sf0.001").collect()
    ids = {d: np.array(ids_of(library, t), "<u4") for d, t in rows}
    assert all(r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id]) for r in got)
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
