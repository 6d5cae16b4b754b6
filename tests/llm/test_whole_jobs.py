"""Results that must not depend on how large a table, a partition or a broadcast is."""

import random

from hitlens.llm import license_rules, page_wrappers, toxicity_models


def _labelled(spark, n=240):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    bad = ["scumbag", "idiotic", "moronic", "loserly"]
    rows = []
    for k in range(n):
        line = rng.sample(words, rng.randint(0, 12)) + (rng.sample(bad, 2) if k % 4 == 0 else [])
        rng.shuffle(line)
        rows.append((k, " ".join(line), int(k % 4 == 0)))
    rows += [rows[7], rows[8], (900, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_toxicity_keeps_every_gram(spark):
    docs, labels = _labelled(spark)
    sample = toxicity_models.training_sample(labels)
    words = toxicity_models.vocabulary(docs, sample, "text").cache()
    found = toxicity_models.evidence(words)
    by_gram = {r["gram"]: r for r in found.collect()}
    assert len(by_gram) > 1000
    for r in toxicity_models.word_scores(words, found, block=500).collect():
        padded = f"\x02{r['word']}\x03"
        grams = [padded[max(0, i - toxicity_models.ORDER) : i] for i in range(2, len(padded) + 1)]
        for name in toxicity_models.HALVES:
            assert abs(r[name] - sum(by_gram[g][name] for g in grams if g in by_gram)) < 1e-9


def test_toxicity_does_not_depend_on_the_table_sent(spark):
    docs, labels = _labelled(spark)
    want = sorted((r.doc_id, round(r.score, 9)) for r in toxicity_models.scored(docs, labels).collect())
    assert len({score for _, score in want}) > 100
    for most in (0, 30):
        got = toxicity_models.scored(docs, labels, most=most).collect()
        assert sorted((r.doc_id, round(r.score, 9)) for r in got) == want


def _texts(pages):
    wrapper = page_wrappers.Wrapper()
    trees = [page_wrappers.parse(page) for page in pages]
    pairs = [wrapper.align(page_wrappers.Skeleton((t.tag, t.names), [t])) for t in trees]
    return [page_wrappers.main_text(t, wrapper.template(p)) for t, p in zip(trees, pairs, strict=True)]


def test_constant_siblings_are_template():
    pages = [f"<body><p>Story {k}</p><p>Follow us</p><p>More {k}</p><p>Even {k}</p></body>" for k in range(200)]
    assert _texts(pages) == [f"Story {k}\n\nMore {k}\n\nEven {k}" for k in range(200)]
    many = ["<body>" + "".join(f"<p>Line {k} {i}</p>" for i in range(100)) + "<p>Follow us</p></body>" for k in range(60)]
    assert all("Follow us" not in text and text.count("Line") == 100 for text in _texts(many))


def test_copies_of_a_page_are_no_template():
    page = "<body><h1>Head</h1><p>Story</p></body>"
    assert _texts([page] * 6) == ["Head\n\nStory"] * 6
    others = [f"<body><h1>Head {k}</h1><p>Story {k}</p><h3>Follow us</h3></body>" for k in range(6)]
    mixed = _texts(others + [page] * 60)
    assert mixed == [f"Head {k}\n\nStory {k}" for k in range(6)] + ["Head\n\nStory"] * 60


def test_license_texts_without_a_name(spark):
    texts = {
        "Permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
        "Permission to use, copy, modify, and/or distribute this software for any purpose": "isc",
        "Redistribution and use in source and binary forms, with or without modification": "bsd",
        "Neither the name of the copyright holder nor the names of its contributors may": "bsd-3-clause",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND': "warranty-disclaimer",
        'This software is provided by the authors "as is" and': "warranty-disclaimer",
        "(c) 2020 Somebody. All rights reserved.": "all-rights-reserved",
        "you may not use this file except in compliance with the License.": "apache",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [d.label for d in r.detections] for r in license_rules.scanned(df).collect()}
    assert [got[k] for k in range(len(texts))] == [[label] for label in texts.values()]
    assert all(len(pattern.split()) <= license_rules.SPAN for _, pattern, *_ in license_rules.BODIES)


def test_long_chunks_are_not_kept():
    from hitlens.llm import chunk_codec, sequence_files, word_tokens

    texts = ["".join(chr(97 + (k * j) % 26) for j in range(5000)) + " word" for k in range(1, 30)]
    table = chunk_codec.ChunkTable(chunk_codec.model_path())
    assert table.encode(texts) == table.encode(texts) and max(map(len, table.known)) <= chunk_codec.LONG
    words = word_tokens.WordTable(sequence_files.tokenizer_path())
    assert [words.encode(t) for t in texts] == [words.encode(t) for t in texts]
    assert max(map(len, [*words.chunks, *words.pieces])) <= word_tokens.LONG


def test_quality_bits_and_policies(spark):
    from hitlens.llm import quality_ledger as q

    clean = " ".join(["the house of words and the river"] * 1 + [f"wort{k} und mot{k} the" for k in range(30)])
    texts = {
        "clean": clean,
        "numbers": " ".join(f"{k}" for k in range(80)) + " the of",
        "no stop words": " ".join(f"wort{k}" for k in range(80)),
        "ellipses": "\n".join(f"the line of words {k} goes on..." + " \t" * (k % 2) for k in range(20)),
        "one ellipsis": clean + "\nand so on…\n" + clean,
    }
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    rows = {r.name: r for r in q.ledger(df).select("*", q.passes("3").alias("three"), q.passes("4").alias("four")).collect()}
    fails = {name: {rule.name for rule in q.RULES if r.failed_bits >> rule.bit & 1} for name, r in rows.items()}
    assert fails["clean"] == set() and rows["clean"].three and rows["clean"].four
    assert "letters" in fails["numbers"] and fails["no stop words"] == {"stop_words"} and "ellipses" in fails["ellipses"]
    assert fails["one ellipsis"] & {"ellipses"} == {"ellipses"} and rows["one ellipsis"].n_ellipsis_lines == 1
    assert rows["no stop words"].three and not rows["no stop words"].four
    effect = {r.rule: r for r in q.ablations(q.ledger(df), "4").collect()}
    assert effect["stop_words"].n_failed_only == 1 and "stop_words" not in {r.rule for r in q.ablations(q.ledger(df), "3").collect()}
