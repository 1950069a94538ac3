import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickflow.llm import substring_dedup as D
from clickflow.llm.common import documents
from clickflow.llm.run_index import RunIndex
from tests.llm import brute
from tests.llm.conftest import SF001


def digests(df):
    rows = df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept")).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in rows}


@pytest.mark.parametrize("seed", range(25))
def test_index_answers_every_window(seed):
    r = random.Random(seed)
    base = [bytes(r.choice(b"ab\x00\xff") for _ in range(81)) for _ in range(3)]
    strings = []
    for _ in range(r.randint(1, 30)):
        k = r.randint(50, 81)
        i = r.randint(0, 81 - k)
        s = bytearray(r.choice(base)[i : i + k])
        if r.random() < 0.5:
            s[r.randrange(len(s))] = 97
        strings.append(bytes(s))
    strings = list(dict.fromkeys(strings))
    owner = np.sort(np.array([r.randint(-5, 9) for _ in strings]))
    at = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    buf = np.frombuffer(b"".join(strings), np.uint8)
    index = RunIndex(buf, at, owner)
    got = index.least_owners(np.diff(at), D.WINDOWS)
    first = {}
    for s, o in zip(strings, owner):
        for i in range(len(s) - 49):
            first[s[i : i + 50]] = min(first.get(s[i : i + 50], 99), o)
    for j, s in enumerate(strings):
        for i in range(len(s) - 49):
            assert got[j, i] == first[s[i : i + 50]]
    # sampled run ends locate every suffix
    assert sorted(index.locate(p) for p in range(index.n)) == list(range(index.n))


def test_documents_match_brute_force(spark, frame, odd_rows):
    docs = documents(spark, SF001)
    assert digests(D.substring_dedup(docs, with_text=False)) == brute.substrings([(r.doc_id, r.text) for r in docs.collect()])
    assert digests(D.substring_dedup(frame(odd_rows), with_text=False)) == brute.substrings(odd_rows)


@pytest.mark.parametrize("seed", range(3))
def test_small_batches_and_periodic_texts(spark, frame, monkeypatch, seed):
    monkeypatch.setattr(D, "BATCH_BYTES", 700)
    r = random.Random(seed)
    parts = ["".join(r.choice("abé ") for _ in range(r.randint(20, 150))) for _ in range(12)] + ["ab" * 80, "a" * 130]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 4)))) for i in range(60)]
    r.shuffle(rows)
    got = digests(D.substring_dedup(frame(rows).repartition(5), with_text=False))
    assert got == brute.substrings(rows)


def test_real_outputs_and_odd_tables(frame, odd_rows, no_id_rows):
    texts = dict(odd_rows)
    for r in D.substring_dedup(frame(odd_rows)).collect():
        raw = (texts[r.doc_id] or "").encode()
        spans = np.frombuffer(r.removed, "<i8").reshape(-1, 2).tolist()
        for a, b in reversed(spans):
            raw = raw[:a] + raw[b:]
        assert raw == r.kept
    got = D.substring_dedup(frame(no_id_rows)).collect()
    assert len(got) == len(no_id_rows)
    # rows of doc 5 keep their text; rows without an id lose what doc 5 has
    assert [r.n_removed for r in got if r.doc_id == 5] == [0, 0, 0]
    assert sorted(r.n_bytes - r.n_removed for r in got if r.doc_id is None) == [0, 0, 0, 11]
    assert D.substring_dedup(frame([])).collect() == []
