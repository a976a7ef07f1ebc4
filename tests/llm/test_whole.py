"""Where operators once did less than the whole job."""

from __future__ import annotations

import random

from membervane.llm import linealign

DOCS = "doc_id long, text string"


def kept_lines(spark, texts, **rule):
    return {r.doc_id: r.text for r in linealign.dedup_blocks(spark.createDataFrame(sorted(texts.items()), DOCS), **rule).collect()}


def long_line(rng):
    return " ".join(rng.choice("alpha beta gamma delta omega kappa".split()) + str(rng.randrange(1000)) for _ in range(9))


def test_copies_go_whole(spark):
    """Lines that third documents held first, and lines that occur once more, do not cut a copied block."""
    rng = random.Random(1)
    stubs = [f"Stub {k}." for k in range(4)]
    texts = {k: f"{long_line(rng)}\n{stubs[k % 4]}\n{long_line(rng)}" for k in range(100)}
    block = [long_line(rng), stubs[0], long_line(rng), stubs[1], stubs[2], long_line(rng)]
    texts[200] = "\n".join(block)
    texts[201] = "\n".join(block)
    texts[202] = "\n".join([stubs[0], "new words", *block])
    found = kept_lines(spark, texts)
    assert found[200] == texts[200] and found[201] == "" and found[202] == f"{stubs[0]}\nnew words"
    assert all(found[k] == texts[k] for k in range(100))


def test_blocks_equal_all_pairs(spark):
    """Documents made of passages in one order against every earlier document, each pair by itself."""
    rng = random.Random(2)
    passages = [[long_line(rng) if rng.random() < 0.5 else f"s{rng.randrange(12)}" for _ in range(rng.randrange(1, 6))] + [long_line(rng)] for _ in range(40)]
    texts = {}
    for i in range(120):
        picked = [passages[k] for k in sorted(rng.sample(range(40), rng.randrange(1, 6)))]
        texts[i] = "\n".join(line for p in picked for line in [*p, f"own {i} {rng.random()}"])
    split = {i: t.split("\n") for i, t in texts.items()}
    want = {}
    for i, lines in split.items():
        gone = set()
        for j in range(i):
            for a in range(len(lines)):
                for b in range(len(split[j])):
                    n = 0
                    while a + n < len(lines) and b + n < len(split[j]) and lines[a + n] == split[j][b + n]:
                        n += 1
                    if any(len(line.split()) >= 8 for line in lines[a : a + n]):
                        gone.update(range(a, a + n))
        want[i] = gone
    found = kept_lines(spark, texts, rare_documents=0)
    assert found == {i: "\n".join(x for k, x in enumerate(lines) if k not in want[i]) for i, lines in split.items()}


def test_blocks_of_odd_rows(spark):
    rows = [(1, "The house is by the river and the old mill."), (2, None), (3, ""), (None, "The house is by the river and the old mill."), (4, " \n\t "), (5, "The house is by the river and the old mill."), (5, "x")]
    df = spark.createDataFrame(rows, DOCS)
    found = sorted((str(r.doc_id), str(r.text), r.lines_removed) for r in linealign.dedup_blocks(df).collect())
    assert found == sorted((str(i), "" if (i, t) == (5, rows[0][1]) else str(t), int((i, t) == (5, rows[0][1]))) for i, t in rows)
    assert linealign.dedup_blocks(df.where("false")).count() == 0


def test_blocks_of_short_lines_go_in_any_number_of_copies(spark):
    verse = "\n".join(f"Line {k} of it" for k in range(6))
    chinese = "这是一个没有空格的很长的段落它在许多文件里一字不差地出现所以应该被删除因为它不会偶然重复出现"
    table = "\t".join(f"cell{k}" for k in range(9))
    texts = {k: f"own {k}\n{verse}\nOK\nmine {k}\n{chinese}\nhers {k}\n{table}" for k in range(30)}
    for k in range(30, 60):
        texts[k] = f"own {k}\nOK\nmine {k}"
    found = kept_lines(spark, texts)
    assert found[0] == texts[0]
    assert all(found[k] == f"own {k}\nmine {k}\nhers {k}" for k in range(1, 30))  # the block of verse and OK
    assert all(found[k] == texts[k] for k in range(30, 60))  # one short line that 60 documents hold


def test_documents_without_a_word_go(spark):
    import corpus_pipeline

    text = "The house is by the river and the old mill.\n\n \n\nAnd the second line stands here as it did before."
    rows = [(k, text, "en", "a", len(text)) for k in range(3)] + [(7, " \n ", "en", "a", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.dedup_lines(spark, docs, "").collect()
    assert {r.doc_id: r.text for r in found} == {0: text, 7: " \n "}


def test_near_dedup_takes_the_radius_of_the_operator(spark):
    """Copies that differ in at most three bits go, all others stay, and so do different texts of one id."""
    import corpus_pipeline
    from membervane.llm import simhash

    rng = random.Random(7)
    words = [f"w{k}" for k in range(400)]
    texts = {k: " ".join(rng.choice(words) for _ in range(400)) for k in range(40)}
    for k in range(40, 80):  # copies with one word, or the last tenth, replaced
        kept = texts[k - 40].split()
        texts[k] = " ".join(["new", *kept[1:]] if k % 2 else kept[:360] + [rng.choice(words) for _ in range(40)])
    rows = [(k, t, "en", "a", len(t)) for k, t in texts.items()] + [(3, "another text of the same id", "en", "a", 27), (3, texts[3], "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    found = sorted((r.doc_id, r.text) for r in corpus_pipeline.dedup_near(spark, docs, "").collect())
    prints = {r.doc_id: r.fingerprint for r in simhash.fingerprints(docs.where("n_chars > 30"), 3, 1).collect()}
    far = [k for k in range(80) if not any((prints[k] ^ prints[j]).bit_count() <= 3 for j in range(k))]
    assert found == sorted([*((k, texts[k]) for k in far), (3, "another text of the same id")]) and 40 < len(far) < 80
