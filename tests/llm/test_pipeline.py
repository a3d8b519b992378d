import re

import corpus_pipeline
from emporium.llm import decontaminate, toxicity
from emporium.llm.common import read
from tests.llm.helpers import words
from tests.llm.test_decontaminate import closest, plain_words
from tests.llm.test_near_dedup import brute


def test_stages_hold_against_brute_force(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]
    stage = dict(corpus_pipeline.STAGES)

    clean = stage["toxicity"](spark, docs, sf_dir)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    ok = {r.doc_id for r in toxicity.score(docs, model).where("p_toxic < 0.5").collect()}
    assert {r.doc_id for r in clean.collect()} == ok and clean.columns == docs.columns

    one = stage["near_dedup"](spark, clean, sf_dir)
    groups = brute([(i, texts[i]) for i in ok], 5, 80)
    single = {i for i, (_, c) in groups.items() if i == c}
    assert {r.doc_id for r in one.collect()} == single and one.columns == docs.columns

    free = stage["decontamination"](spark, one, sf_dir)
    items = [plain_words(r.text) for r in read(spark, sf_dir, "benchmark").collect()]
    held = set()
    for i in single:
        t = plain_words(texts[i])
        grams = {tuple(t[k:k + 3]) for k in range(len(t))}
        for p in items:  # within a fifth of the words, some three in a row are whole
            if any(tuple(p[k:k + 3]) in grams for k in range(len(p) - 2)) and closest(p, t) <= len(p) // 5:
                held.add(i)
    kept = {r.doc_id for r in free.collect()}
    assert kept == single - held and held and free.columns == docs.columns

    named = stage["pii"](spark, free, sf_dir)
    assert named.columns == docs.columns
    for r in named.collect():
        assert r.n_chars == len(r.text) and len(words(r.text)) == len(words(texts[r.doc_id]))
        for mail in re.findall(r"[\w.]+@[\w.]+\w", texts[r.doc_id]):
            assert mail not in r.text

    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == kept
    assert corpus_pipeline.ORACLE_SQL is None and decontaminate.MIN_WORDS == 4
