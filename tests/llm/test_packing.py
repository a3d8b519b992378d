import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from emporium.llm import packing
from emporium.llm.registry import tokenizer_file
from tests.llm.helpers import empty_documents, odd_documents


def check_packed(rows, docs, capacity):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_file())
    own, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(own) == set(docs)
    for doc, (text, copies) in docs.items():
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want = [(k, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes()))
                for k, s in enumerate(range(0, len(ids), capacity))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in own[doc]) == sorted(want * copies)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_and_places(spark):
    docs = odd_documents(spark)
    rows = docs.collect()
    texts = {r.doc_id: (r.text, sum(x.doc_id == r.doc_id for x in rows)) for r in rows}
    got = packing.pack(docs, tokenizer_file(), capacity=256).collect()
    n = check_packed(got, texts, 256)
    # Best fit: no two sequences could share one.
    filled = Counter()
    for r in got:
        filled[r.sequence_id] += r.length
    least = sorted(filled.values())[:2]
    assert n == len(filled) and sum(least) > 256
    with_ids = packing.pack(docs, tokenizer_file(), capacity=256, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in with_ids)
    assert packing.pack(empty_documents(spark), tokenizer_file()).collect() == []


def test_token_ids_equal_the_tokenizers(spark):
    import pyarrow as pa

    from emporium.llm.common import string_buffers
    ids = packing.word_ids(tokenizer_file())
    odd = ["Don't İstanbul é É　x y\x1cz ſ K Ω ﬁ    a​b ΑΣ.", "naïve×3÷2’s don't ''s l'l 5's '5 x'ÉÀ",
           "Ǆǆ ŉ a̐b ½x ²3 a***b&& THE!! 4225!!", "", "a" * 5000, "z 😀\u200d日本 1e5"]
    for texts in (odd, [*odd, "a <|endoftext|> B<|ENDOFTEXT|>x"]):
        got = ids(*string_buffers(pa.array(texts, pa.large_string())))
        for text, x in zip(texts, got):
            assert ids.tok.encode(text, add_special_tokens=False).ids == x.tolist()


def test_plan_uses_each_piece_once_and_nearly_fills():
    rng = random.Random(1)
    for counts in ({4096: 7}, {1: 5000}, {3000: 4, 1096: 2, 548: 4}, {2000: 1, 1000: 1, 700: 1, 396: 1},
                   {rng.randrange(1, 4097): rng.randrange(1, 50) for _ in range(600)}):
        runs, used = packing.plan(dict(counts), 4096), Counter()
        for lengths, times in runs:
            assert times > 0 and sum(lengths) <= 4096
            for x in lengths:
                used[x] += times
        assert used == Counter(counts)
    assert sum(t for _, t in packing.plan({3000: 4, 1096: 2, 548: 4}, 4096)) == 4
    assert packing.plan({2000: 1, 1000: 1, 700: 1, 396: 1}, 4096) == [((2000, 1000, 700, 396), 1)]
