import zlib
from collections import defaultdict

import numpy as np
import pytest

from delivery_marts.llm import packing, params, queries
from tests.llm.conftest import ODD, SF_DIR
from tests.llm.test_token_files import whole


@pytest.mark.parametrize("capacity", [2048, 100, 7, 1])
def test_cuts_add_up_and_are_classes(capacity):
    allowed = set(packing.sizes(capacity))
    for tokens in (*range(1, 3 * capacity), 10_000_019):
        lengths = packing.cuts(tokens, capacity)
        assert sum(lengths) == tokens and set(lengths) <= allowed


def test_a_class_wastes_less_than_one_piece_per_bin():
    assert all(packing.CAPACITY - packing.CAPACITY // s * s < min(s, 64) for s in packing.sizes())


def check(rows, ids_of):
    """Pieces cover every document once and fill sequences without overlap or gap."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(ids_of)
    for doc_id, pieces in by_doc.items():
        ids, at = np.array(ids_of[doc_id], "<u4"), 0
        for start, length, crc, tokens in sorted(pieces):
            assert start == at and tokens == len(ids)
            assert crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    lengths = []
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
        lengths.append(at)
    return sum(packing.CAPACITY - n for n in lengths) / (packing.CAPACITY * len(lengths))


def test_query_packs_every_document_with_little_padding(spark, texts):
    plain = whole(params.BYTE_BPE)
    rows = queries.op8_packing(spark, SF_DIR).collect()
    assert check(rows, {d: [*plain(t), 1] for d, t in texts.items()}) < 0.02


def test_odd_rows_and_real_sequences(spark, odd):
    rows = odd.where("doc_id IS NULL OR doc_id <> 9")
    pieces = packing.written(packing.cut(rows, params.tokenizer(params.BYTE_BPE), True, 1), "test-pieces")
    placed = packing.written(packing.place(pieces), "test-placed")
    plain = whole(params.BYTE_BPE)
    ids_of = {d: [*plain(t or ""), 1] for d, t in ODD if d != 9}
    found = defaultdict(dict)
    for row in packing.sequences(placed).collect():
        ids = np.frombuffer(row.ids, "<u4")
        assert len(ids) <= packing.CAPACITY
        for p in row.pieces:
            found[p.doc_id][p.start] = ids[p.offset : p.offset + p.length].tolist()
    assert {d: [i for s in sorted(parts) for i in parts[s]] for d, parts in found.items()} == ids_of


def test_repeated_rows_are_packed_each(spark, odd):
    nine = queries.packed(odd.where("doc_id = 9")).collect()
    plain = whole(params.BYTE_BPE)
    assert sum(r.length for r in nine) == sum(len(plain(t)) + 1 for d, t in ODD if d == 9)
    spans = sorted((r.sequence_id, r.offset, r.length) for r in nine)
    assert all(a[0] != b[0] or a[1] + a[2] == b[1] for a, b in zip(spans, spans[1:], strict=False))
