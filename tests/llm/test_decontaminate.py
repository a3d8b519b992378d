import random
import re

import pyarrow as pa

from emporium.llm import decontaminate
from emporium.llm.common import string_buffers
from tests.llm.helpers import WORDS, empty_documents, odd_documents, prose


def plain_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def closest(pattern, text):
    """Least edit distance of the pattern to any run of the text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for x in text:
        new = [0]
        for i, p in enumerate(pattern, start=1):
            new.append(min(row[i - 1] + (p != x), row[i] + 1, new[i - 1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_bit_parallel_distance_equals_the_table():
    rng = random.Random(8)
    for _ in range(300):
        a = [rng.randrange(5) for _ in range(rng.randrange(1, 90))]
        b = [rng.randrange(5) for _ in range(rng.randrange(0, 120))]
        edits, end = decontaminate._closest(a, b)
        assert edits == closest(a, b)
        anchored, back = decontaminate._closest(a[::-1], b[:end][::-1], anchored=True)
        assert anchored == edits and closest(a, b[end - back:end]) == edits


def planted(seed, items, rates):
    rng, docs = random.Random(seed), []
    for rate in rates:
        for k, item in enumerate(items):
            w = item.split()
            for _ in range(int(rate * len(w))):
                at, how = rng.randrange(len(w)), rng.randrange(3)
                w[at:at + (how < 2)] = [[], [prose(rng, 1)], [prose(rng, 1)]][how] + ([] if how < 2 else [])
            docs.append((k, prose(rng, 40) + "\n" + " ".join(w) + ". " + prose(rng, 40)))
    return docs


def test_finds_equal_brute_force(spark):
    rng = random.Random(1)
    items = [prose(rng, n) for n in (5, 9, 17, 24, 40, 60)]
    docs = [(i, t) for i, (_, t) in enumerate(planted(2, items, (0, 0.1, 0.2)))]
    docs += [(900 + r.doc_id, r.text) for r in odd_documents(spark).collect()]
    docs += [(800, items[3].upper().replace(" ", "!! "))]
    bench = spark.createDataFrame([*enumerate(items), (77, None), (78, "too short"), (79, items[2])],
                                  "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.find(frame, bench).collect()
    want = {}
    for d, t in docs:
        for i, item in [*enumerate(items), (79, items[2])]:
            p = plain_words(item)
            e = closest(p, plain_words(t))
            if e <= len(p) * 20 // 100:
                want[d, i] = e
    found = {(r.doc_id, r.item_id): r.edits for r in got}
    assert set(found) <= set(want) and len(found) >= 0.95 * len(want)
    assert all(found[k] == want[k] for k in found)
    assert all((k in found) for k, e in want.items() if e == 0)
    text = dict(docs)
    for r in got:
        p, t = plain_words(items[r.item_id if r.item_id != 79 else 2]), plain_words(text[r.doc_id])
        assert closest(p, t[r.start_word:r.end_word]) == r.edits
    blocks = decontaminate.find(frame, bench, decontaminate.Settings(block_chars=200)).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, got))
    kept = {r.doc_id for r in decontaminate.keep_clean(frame, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in found}


def test_recall_at_the_full_distance():
    rng = random.Random(3)
    items = [prose(rng, rng.randrange(16, 60)) for _ in range(120)]
    index = decontaminate.Items(list(range(len(items))), items, decontaminate.Settings())
    hit = total = 0
    for k, text in planted(4, items, (0.2,)):
        p, t = plain_words(items[k]), plain_words(text)
        if closest(p, t) <= len(p) // 5:
            total += 1
            hit += any(x[1] == k for x in decontaminate._finds(index, *string_buffers(pa.array([text]))))
    assert total > 100 and hit >= 0.95 * total


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, " ".join(WORDS))], "item_id long, text string")
    assert decontaminate.find(empty_documents(spark), bench).collect() == []
    docs = odd_documents(spark)
    assert decontaminate.find(docs, bench.limit(0)).collect() == []
    assert decontaminate.keep_clean(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.keep_clean(docs, bench).columns == docs.columns


def test_recall_of_short_items():
    rng = random.Random(9)
    for n in (4, 5, 7, 8, 10, 12, 15):
        items = [prose(rng, n) for _ in range(60)]
        index = decontaminate.Items(list(range(len(items))), items, decontaminate.Settings())
        for rate, least in ((0, 1.0), (0.2, 0.9)):
            hit = total = 0
            for k, text in planted(n, items, (rate,)):
                p, t = plain_words(items[k]), plain_words(text)
                if closest(p, t) <= len(p) // 5:
                    total += 1
                    hit += any(x[1] == k for x in decontaminate._finds(index, *string_buffers(pa.array([text]))))
            assert total >= 50 and hit >= least * total, (n, rate, hit, total)


def test_items_of_few_words_and_scripts_without_spaces(spark):
    items = [(1, "Paris is big"), (2, "机器学习模型需要大量的训练数据。"), (3, "猫很大"), (None, "Osmium weighs most"),
             (5, "ประเทศไทยมีอากาศร้อน"), (6, "?!"), (7, "Paris is big"), (8, "zyx")]
    docs = [(1, "He says Paris IS big, and so on"), (2, "我们知道，机器学习模型需要大量的训练数据！所以"), (3, "那只猫很大。"),
            (4, "osmium weighs most of all"), (5, "ก็ประเทศไทยมีอากาศร้อนมาก"), (6, "Paris is"), (7, "big Paris was"),
            (8, "机器学习模型需要大最的训练数据"), (9, "猫很小"), (10, None), (11, "?!"), (12, "zyx, zyx " * 3),
            (13, "the big"), (14, "Paris"), (15, "is big")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find(frame, bench).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in got} == {
        (1, 1, 0), (1, 7, 0), (2, 2, 0), (3, 3, 0), (4, None, 0), (5, 5, 0), (8, 2, 1), (12, 8, 0)}
    assert [(r.start_word, r.end_word) for r in got if r.doc_id in (1, 12)] == [(2, 5), (2, 5), (0, 1)]
    kept = {r.doc_id for r in decontaminate.keep_clean(frame, bench).collect()}
    assert kept == {6, 7, 9, 10, 11, 13, 14, 15}
