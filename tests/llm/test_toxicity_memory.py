"""The passes of the fit give back what they held: workers outlive their tasks."""

import numpy as np
import pyarrow as pa

from quarry.llm import toxicity


def test_highest_windows_begin_and_give_back(monkeypatch):
    calls = []
    monkeypatch.setattr(toxicity, "begin_task", lambda: calls.append("begin"))
    monkeypatch.setattr(toxicity, "give_back", lambda: calls.append("back"))
    model = toxicity.Model({"bad": 1}, {})
    model.params = toxicity.train(model, [["bad"], ["fine"]], np.array([1.0, 0.0]), steps=2)
    batch = pa.RecordBatch.from_arrays([pa.array(["a bad day", None, "fine"])], names=["text"])
    out = [w for b in toxicity._highest_windows(model)(iter([batch])) for w in b.column("words").to_pylist()]
    assert out == [["a", "bad", "day"], ["fine"]]
    assert calls == ["begin", "back"]


def test_new_words_are_looked_up_together_like_one_by_one(monkeypatch):
    many = "".join(map(chr, range(0x4E00, 0x4E00 + 9000)))  # more letters than a number tells apart
    words = ["a", "ab", "bad", "aaaaaaaa", "äöü", "слово", "worse", "漢字", many, *(f"word{chr(97 + i)}" for i in range(20))]
    model = toxicity.Model({"bad": 1, "слово": 2}, {"<bad>": 1, "aaaaa": 2, "words": 3})
    inputs = toxicity.Inputs(model)
    assert inputs.look_up(["bad", *words, "bad"]).tolist() == [1, 2, 3, 1, *range(4, len(words) + 1), 1]
    word, grams, sizes = inputs.flat()
    known = list(inputs)
    found = np.split(grams, np.cumsum(sizes)[:-1])
    assert (word[0], sizes[0]) == (0, 0)
    assert [(w, tuple(g.tolist())) for w, g in zip(word[1:], found[1:])] == [model.inputs(w) for w in known[1:]]
    model.params = toxicity.train(model, [["bad"], ["fine"]], np.array([1.0, 0.0]), steps=2)
    monkeypatch.setattr(toxicity, "CACHE_ENTRIES", 5)
    kept = toxicity.Vectors(model)
    for _ in range(2):
        ids = kept.look_up(words[:9])
        assert np.array_equal(kept.vectors[ids], toxicity.vectors(model.params, inputs.flat())[inputs.look_up(words[:9])])
    assert len(kept.vectors) == len(kept) == 10


def test_each_pass_of_the_fit_reads_the_sample_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)
    real = toxicity._highest_windows

    def counted(model):
        run = real(model)

        def go(batches):
            def seen():
                for b in batches:
                    read.add(b.num_rows)
                    yield b

            return run(seen())

        return go

    monkeypatch.setattr(toxicity, "_highest_windows", counted)
    docs = spark.createDataFrame([(i, f"some words stand here {'bad' if i % 2 else 'fine'}") for i in range(40)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, hard_rounds=1, hard_steps=2)
    assert read.value == 20  # the clean ones
