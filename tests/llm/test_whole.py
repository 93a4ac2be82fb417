"""Places where an operator of vecspark.llm once did less than the whole job."""

import random

import numpy as np
from pyspark.sql import functions as F

from vecspark.llm import licenses, quality, topk, toxicity
from vecspark.llm.common import labelled_sample


def labelled(spark, n, share, seed):
    """``n`` short texts; a ``share`` of them has label 1, which a word hints at in half of them only."""
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        y = int(rng.random() < share)
        own = ["".join(rng.choice(["ka", "lo", "mi", "ter", "un"]) for _ in range(3)) for _ in range(12)]
        if y and rng.random() < 0.5 or rng.random() < 0.05:
            own.insert(rng.randrange(12), "scumlord")
        texts.append((i, " ".join(own), 100))
        labels.append((i, y, y))
    docs = spark.createDataFrame(texts, "doc_id long, text string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), np.mean([y for _, y, _ in labels])


def test_bounded_sample_keeps_the_natural_rate(spark):
    docs, labels, rate = labelled(spark, 3000, 0.1, 3)
    model = toxicity.train(docs, labels, F.lit(True), per_class=150)
    mean = docs.select(F.avg(model.column("text"))).first()[0]
    assert abs(mean - rate) < 0.05
    model = quality.train(docs, labels, F.lit(True), per_class=150)
    mean = docs.select(F.avg(model.column("text", "n_chars"))).first()[0]
    assert abs(mean - rate) < 0.08


def test_grams_of_very_short_pieces():
    for texts in ([b""], [b"a"], [b"x" * (2 * toxicity.BLOCK)], [b"x" * (2 * toxicity.BLOCK + 1), b""], [b"x" * (toxicity.BLOCK + 1), b"", b"a"]):
        rows, slots = toxicity.gram_slots(texts, 20)
        got = {i: set(slots[rows == i].tolist()) for i in range(len(texts))}
        for i, t in enumerate(texts):
            alone = toxicity.gram_slots([t[:100] if len(t) > 100 else t, b"other words"], 20)
            assert got[i] == set(alone[1][alone[0] == 0].tolist())


def test_sample_has_one_row_of_a_repeated_key(spark):
    docs, labels, _ = labelled(spark, 60, 0.3, 4)
    hot = spark.range(500).select(F.lit(0).cast("long").alias("doc_id"), F.concat(F.lit("copy "), F.col("id")).alias("text"), F.lit(9).cast("long").alias("n_chars"))
    docs = docs.unionByName(hot).unionByName(hot).repartition(7)
    first = labelled_sample(docs, labels, "doc_id", "toxic", F.lit(True), 1000, "text", "n_chars").collect()
    again = labelled_sample(docs.repartition(3), labels, "doc_id", "toxic", F.lit(True), 1000, "text", "n_chars").collect()
    assert sorted(r["_dk"] for r in first) == list(range(60))
    assert sorted(first) == sorted(again)
    few = labelled_sample(docs, labels, "doc_id", "toxic", F.lit(True), 5, "text").collect()
    assert len(few) == 10 and {r["_y"] for r in few} == {0, 1}


def test_licence_notices_over_lines_and_in_long_lines():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "ter", "un"]) for _ in range(3))
    model = licenses.fit([" ".join(word() for _ in range(rng.randint(3, 200))) for _ in range(400)])
    wrapped = {
        "MIT": "// Permission is hereby granted, free of charge, to any person obtaining a copy\n// of this software and associated documentation files (the \"Software\"), to deal\n// in the Software without restriction, including without limitation the rights",
        "BSD": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:",
        "GPL-3.0": "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.",
        "GPL-2.0": "you can redistribute it and/or\nmodify it under the terms of the GNU General Public License\nas published by the Free Software Foundation; either version 2\nof the License, or (at your option) any later version.",
        "LGPL": "modify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
        "AGPL-3.0": "it under the terms of the GNU Affero General Public License as\npublished by the Free Software Foundation, either version 3 of the\nLicense, or (at your option) any later version.",
        "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that",
        "Apache-2.0": "you may not use this file except in compliance with\nthe License. You may obtain a copy of the License at\n\n   http://www.apache.org/licenses/LICENSE-2.0",
    }
    prose = lambda n: " ".join(word() for _ in range(n))
    for family, text in wrapped.items():
        for whole in (text, f"{prose(30)}\n\n{text}\n\n{prose(30)}", f"{prose(90)}\n{text}\n{prose(90)}"):
            got = [p for p in model.paragraphs(whole) if p[5]]
            assert [p[2] for p in got] == [family], (family, got)
            assert whole[got[0][0]: got[0][1]].split()[0] in text
    for family, text in (("MIT", "Released under the MIT License"), ("CC-BY-NC", "Licensed under CC BY-NC 4.0"), ("GPL-3.0", wrapped["GPL-3.0"].replace("\n# ", " "))):
        for before in (0, 3333, 9990):
            whole = f"{prose(before)} İé {text}. {prose(10000 - before)}"
            got = [p for p in model.paragraphs(whole) if p[5]]
            assert [p[2] for p in got] == [family], (family, before, got)
            assert whole[got[0][0]: got[0][1]] in text
    two = model.paragraphs("Released under the MIT License\nLicensed under the Apache License, Version 2.0")
    assert [p[2] for p in two if p[5]] == ["MIT", "Apache-2.0"]
    assert model.paragraphs("") == model.paragraphs(" \n\n//\n") == []
    assert not [p for p in model.paragraphs(prose(5000)) if p[5]]


def test_licences_learn_from_all_paragraphs(monkeypatch):
    rows = []
    features = licenses.LicenceModel.features
    monkeypatch.setattr(licenses.LicenceModel, "features", lambda self, own: rows.append(tuple(own)) or features(self, own))
    licenses.fit([f"p{i} a ka lo" for i in range(3000)], steps=1)
    assert {r[0] for r in rows if len(r) == 4 and r[1:] == ("a", "ka", "lo")} >= {f"p{i}" for i in range(3000)}


def test_equal_vectors_share_no_block(spark, monkeypatch):
    # Blocks are met in workers, so the sizes come back as the products of a stand-in.
    monkeypatch.setattr(topk, "block_topk", lambda q, r, qid, rid, k: [(int(qid[0]), len(rid), len(rid))])
    rows = [(0, [1.0, 2.0])] + [(7, [3.0, 4.0])] * 400 + [(i, [float(i), 1.0]) for i in range(1001, 1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sizes = [r["score"] for r in topk.topk(df, lambda key: key == 0, k=1000, row_block=50).collect()]
    assert sum(sizes) == 600 and max(sizes) < 120


def test_equal_vectors_count_each(spark):
    rows = [(0, [1.0, 2.0])] + [(7, [3.0, 4.0])] * 40 + [(8, [3.0, 3.9])] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block in (5, 1000):
        got = sorted(map(tuple, topk.topk(df, lambda key: key == 0, k=41, row_block=block).collect()))
        assert [r[2] for r in got] == [7] * 40 + [8]
