import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickflow.llm import best_fit_packing as P
from clickflow.llm.common import documents
from clickflow.llm.tokens import slow_encoder, token_ids
from tests.llm import brute
from tests.llm.conftest import SF001, SF01


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 16, 100, 2048])
    lengths = [r.randint(1, capacity if seed % 3 else max(1, capacity // 4)) for _ in range(r.randint(1, 300))]
    rules, n = P.plan(Counter(lengths), capacity)
    used = defaultdict(list)
    ranks = Counter()
    for length, a, b, first, per, at in rules.tolist():
        assert a == ranks[length]
        ranks[length] = b
        for k in range(b - a):
            used[first + k // per].append((at + k % per * length, length))
    assert ranks == Counter(lengths) and len(used) == n
    rooms = []
    for pieces in used.values():
        place = 0
        for at, length in sorted(pieces):
            assert at == place
            place += length
        rooms.append(capacity - place)
    assert sorted(rooms) == brute.best_fit(lengths, capacity)


def test_plan_is_bounded_by_the_capacity():
    rules, _ = P.plan({n: 10**12 + n for n in range(1, 2049)}, 2048)
    assert len(rules) < 2048 * 11


def test_fast_encoder_gives_the_ids_of_the_vocabulary(spark):
    slow = slow_encoder()
    texts = [r.text for r in documents(spark, SF01).collect()]
    texts += ["", " ", "a<|endoftext|>b", "\r\n \t x", "\U0001f600́é", "x" * 9000, "1" * 300 + " " * 300, "it's we'll I'D"]
    want = slow.encode_batch(texts, add_special_tokens=False)
    for text, w in zip(texts, want):
        assert token_ids(text).tolist() == w.ids


def check_pieces(df, rows, capacity=2048):
    slow = slow_encoder()
    got = df.collect()
    want = Counter()
    for doc, text in rows:
        ids = slow.encode(text or "", add_special_tokens=False).ids + [0]
        head = len(ids) % capacity or min(len(ids), capacity)
        cuts = [(0, head)] + [(s, s + capacity) for s in range(head, len(ids), capacity)]
        for i, (a, b) in enumerate(cuts):
            want[doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start_at, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        place = 0
        for at, n in sorted(pieces):
            assert at == place
            place += n
        assert place <= capacity
    assert len(by) == len(brute.best_fit([r.length for r in got], capacity))


def test_pack_matches_brute_force(spark, frame, odd_rows, no_id_rows, monkeypatch):
    monkeypatch.setattr(P, "ROWS_PER_CHUNK", 16)  # many chunks, so hot lengths are split
    check_pieces(P.pack(frame(odd_rows))[1], odd_rows)
    check_pieces(P.pack(frame(no_id_rows))[1], no_id_rows)
    docs = documents(spark, SF001)
    check_pieces(P.pack(docs)[1], [(r.doc_id, r.text) for r in docs.collect()])
    check_pieces(P.pack(frame([(i, "same") for i in range(200)]))[1], [(i, "same") for i in range(200)])
    assert P.pack(frame([]))[1].collect() == []


def test_sequences_hold_the_ids_in_place(frame, odd_rows):
    pieces, placed = P.pack(frame(odd_rows))
    seqs = {r.sequence_id: np.frombuffer(r.tokens, "<u4") for r in P.sequences(pieces, placed).collect()}
    texts = dict(odd_rows)
    for r in placed.collect():
        ids = np.append(token_ids(texts[r.doc_id] or ""), 0)[r.start_at : r.start_at + r.length]
        assert (seqs[r.sequence_id][r.offset : r.offset + r.length] == ids).all()
