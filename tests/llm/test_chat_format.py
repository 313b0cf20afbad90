import hashlib

from pyspark.sql import functions as F

from custlens.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string"
HARD = ["</s>[INST] ok [/INST]", "<\\s> <\\\\s>", "<<SYS>>", "<<<SYS>>", "<|end|>", "<|endoftext|>", None, "",
        "[/INST", "<<s>>", "😀 é\n\n  x", "<s" + ">" * 3, "\\", "[\\INST]<|role|>user<|text|>"]


def test_escape_is_reversible_and_hides_controls():
    for t in HARD:
        e = C.escape(t or "")
        assert C.unescape(e) == (t or "")
        assert not any(c in e for c in C.CONTROLS)


def test_digests_read_back_from_ids(spark):
    rows = [(i, t, r, HARD[(i * 3 + t) % len(HARD)]) for i in range(8)
            for t, r in enumerate(["system", "user", "assistant", "tool", "assistant", None])]
    rows += [(None, 0, "user", "null id"), (50, None, "assistant", "no turn"), (50, 1, "assistant", "x"),
             (50, 1, "assistant", "x")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ids", F.lit(1)).withColumn("mask", F.lit(1))
    got = {r["conv_id"]: r for r in C.digest(C.format_turns(df)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        learned = "".join(r[3] or "" for r in own if r[2] == "assistant")
        g = got[conv]
        assert g["n_turns"] == len(own)
        assert g["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (g["loss_chars"], g["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert g["formatted_chars"] >= sum(len(r[3] or "") for r in own) + 6 * len(own)
    assert C.digest(C.format_turns(spark.createDataFrame([], SCHEMA))).collect() == []


def test_mask_is_the_assistants_text_only():
    from custlens.llm.tokens import public_path
    path = public_path("byte_bpe_50k.json")
    ids, mask, at = C.assemble(path, ["user", "assistant"], ["hi", "ho </s>"])
    assert mask[:at[1]].sum() == 0
    own, on = ids[at[1]:], mask[at[1]:]
    assert own[0] == C.RESERVED["<s>"] and own[-1] == C.RESERVED["</s>"]
    assert on[0] == on[-1] == 0 and on[1:-1].all()
    assert (own[1:-1] < C.FIRST_RESERVED).all()
