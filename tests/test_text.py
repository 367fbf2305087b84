import pytest
from pyspark.sql import functions as F

from quarry.functions import text as TX
from quarry.operators import sampling as X


def test_prompt_instruction_branches(spark):
    df = spark.createDataFrame(
        [(1, "Say hi", "", "hi"), (2, "Add", "1 and 2", "3"), (3, "Q", None, "A")],
        "id int, instruction string, input string, output string",
    )
    got = {r["id"]: r["text"] for r in TX.format_prompt(df, keep=["id"]).collect()}
    assert got[1] == "### Instruction:\nSay hi\n\n### Response:\nhi</s>"
    assert got[2] == "### Instruction:\nAdd\n\n### Input:\n1 and 2\n\n### Response:\n3</s>"
    assert got[3] == "### Instruction:\nQ\n\n### Response:\nA</s>"


def test_prompt_null_output_is_error(spark):
    df = spark.createDataFrame([("x", None)], "instruction string, output string")
    with pytest.raises(Exception):
        TX.format_prompt(df).collect()


def test_prompt_other_branches(spark):
    qa = spark.createDataFrame([("why", "because")], "question string, answer string")
    assert TX.format_prompt(qa).collect()[0]["text"] == "Question: why\nAnswer: because</s>"
    tx = spark.createDataFrame([("plain",)], "text string")
    assert TX.format_prompt(tx, eos="<|end|>").collect()[0]["text"] == "plain<|end|>"
    other = spark.createDataFrame([(1, "z")], "a int, b string")
    assert TX.format_prompt(other).collect()[0]["text"] == '{"a":1,"b":"z"}</s>'


def corpus(spark):
    return spark.createDataFrame(
        [(1, "the cat sat"), (2, "The dog sat down"), (3, "a cat</s>"), (4, "")], "k int, text string"
    )


def test_vocab_order_and_specials(spark):
    v = TX.build_vocab(corpus(spark), "text")
    rows = {r["token"]: r["id"] for r in v.table.collect()}
    assert rows["<pad>"] == 0 and rows["</s>"] == 3
    # counts: sat 2, the 2, cat 2 (cat</s> is one word here), then singletons by token
    assert [t for t, _ in sorted(rows.items(), key=lambda x: x[1])][4:7] == ["sat", "the", "a"] or rows["sat"] < rows["a"]
    assert v.size == len(rows)


def test_vocab_pad_defaults_to_eos(spark):
    v = TX.build_vocab(corpus(spark), "text", specials=("<unk>", "</s>"))
    assert v.pad_id == v.eos_id == 1


def test_tokenise_truncate_and_eos(spark):
    df = corpus(spark)
    v = TX.build_vocab(df, "text")
    ids = {r["token"]: r["id"] for r in v.table.collect()}
    out = {r["k"]: r for r in TX.tokenise(df, v, 3, key="k").collect()}
    assert out[3]["input_ids"] == [ids["a"], ids["cat"], ids["</s>"]]
    assert len(out[2]["input_ids"]) == 3 and out[2]["labels"] == out[2]["input_ids"]
    assert out[2]["attention_mask"] == [1, 1, 1]
    assert out[4]["input_ids"] == []


def test_tokenise_padded(spark):
    df = corpus(spark)
    v = TX.build_vocab(df, "text")
    out = {r["k"]: r for r in TX.tokenise_padded(df, v, 6, key="k").collect()}
    r = out[1]
    assert len(r["input_ids"]) == 6 and r["input_ids"][0] == v.bos_id and r["input_ids"][4] == v.eos_id
    assert r["attention_mask"] == [1, 1, 1, 1, 1, 0] and r["token_type_ids"] == [0] * 6
    long = out[2]["input_ids"]
    assert len(long) == 6 and long[-1] == v.eos_id


def test_pad_batches(spark):
    df = spark.createDataFrame([(i, list(range(1, i + 2))) for i in range(5)], "k int, input_ids array<bigint>")
    numbered = X.renumber(df, ["k"], "row_idx").withColumn("batch", F.floor(F.col("row_idx") / 2))
    out = {r["k"]: r for r in TX.pad_batches(numbered, "batch", 0, 8).collect()}
    assert all(len(r["input_ids"]) % 8 == 0 for r in out.values())
    assert out[0]["labels"][:1] == [1] and out[0]["labels"][1:] == [-100] * 7
    assert out[4]["padded_len"] == 8


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_vocab_and_tokens_partition_invariant(spark, parts):
    base = spark.createDataFrame(
        [(i, " ".join(f"w{(i * j) % 13}" for j in range(1, 12))) for i in range(40)], "k int, text string"
    )
    ref_v = TX.build_vocab(base.coalesce(1), "text")
    ref = sorted(tuple(r) for r in ref_v.table.collect())
    ref_t = sorted((r["k"], tuple(r["input_ids"])) for r in TX.tokenise(base.coalesce(1), ref_v, 8, key="k").collect())
    df = base.repartition(parts)
    v = TX.build_vocab(df, "text")
    assert sorted(tuple(r) for r in v.table.collect()) == ref
    got = sorted((r["k"], tuple(r["input_ids"])) for r in TX.tokenise(df, v, 8, key="k").collect())
    assert got == ref_t


def test_prompt_null_instruction_renders_none(spark):
    df = spark.createDataFrame([(None, None, "x")], "instruction string, input string, output string")
    assert TX.format_prompt(df).collect()[0]["text"] == "### Instruction:\nNone\n\n### Response:\nx</s>"


@pytest.mark.parametrize("max_size", [4, 5, 6, 7, 8, 50])
def test_capped_vocab_equals_prefix_of_full(spark, max_size):
    df = spark.createDataFrame(
        [(1, "b a a c c d"), (2, "a e e f g"), (3, "c h i j")], "k int, text string"
    )
    full = {r["token"]: r["id"] for r in TX.build_vocab(df, "text").table.collect()}
    capped = {r["token"]: r["id"] for r in TX.build_vocab(df, "text", max_size).table.collect()}
    assert capped == {t: i for t, i in full.items() if i < max_size}
