"""Conversations that read back as they were said."""

import hashlib
import random

from pyspark.sql import functions as F

from tablecontract.llm import chat


def read(frame, **options):
    made = chat.format_conversations(frame, **options)
    return made.select("*", chat.turns(F.col("formatted")).alias("turns"), chat.learned(F.col("formatted"), F.col("loss_spans")).alias("loss"))


def test_texts_come_back(spark):
    r = random.Random(1)
    signs = ["<", "\\", "[", "</s>", "[INST]", "<turn>", "<text>", "</turn>", "é漢", "\n", "a ", "$1"]
    rows = [(c, t, r.choice(["user", "assistant", "<turn>x"]), "".join(r.choice(signs) for _ in range(r.randint(0, 9)))) for c in range(60) for t in range(r.randint(1, 6))]
    shuffled = r.sample(rows, len(rows))
    out = {x.conv_id: x for x in read(spark.createDataFrame(shuffled, "conv_id long, turn long, role string, text string")).collect()}
    for c in range(60):
        said = [(role, text) for k, _, role, text in rows if k == c]
        assert [tuple(x) for x in out[c].turns] == said and out[c].n_turns == len(said)
        assert out[c].loss == "".join(t for role, t in said if role == "assistant")
        assert out[c].formatted.count("</turn>") == out[c].formatted.count("<text>") == len(said) and "</s>" not in out[c].formatted and "[INST]" not in out[c].formatted
        for span in out[c].loss_spans:
            assert out[c].formatted[span.start - 6 : span.start] == "<text>"


def test_odd_rows(spark):
    rows = [(1, None, "user", "first"), (1, 2, None, None), (1, 2, "assistant", "x" * 300_000), (1, 2, "assistant", "x" * 300_000), (None, 0, "assistant", ""), (2, 0, "user", "")]
    frame = spark.createDataFrame([(*x, 3) for x in rows], "conv_id long, turn long, role string, text string, N_TURNS int")
    out = {x.conv_id: x for x in read(frame).collect()}
    assert [x.role for x in out[1].turns] == ["user", "", "assistant", "assistant"] and len(out[1].loss) == 600_000
    assert out[None].n_turns == 1 and out[None].loss == "" and out[2].loss_spans == []
    assert read(frame.limit(0)).count() == 0


def test_typed_parts(spark):
    part = chat.PART.replace("struct<", "").replace(">", "").split(",")
    names = [p.split(":")[0] for p in part]
    make = lambda **k: tuple(k.get(n) for n in names)
    parts = [make(type="text", text="see <image> "), make(type="image", uri="s3://a", width=29, height=14), make(type="audio", uri="b", seconds=1.01),
             make(type="document", uri="c", pages=3), make(type="poem", text="odd"), make(), make(type="image")]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", None), (2, 0, "user", [])]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, said array<{chat.PART}>")
    one, two = sorted(chat.format_conversations(frame, parts="said").collect(), key=lambda r: r.conv_id)
    assert one.formatted == "<turn>user<text>see <\\image> <image><audio><document>odd<image></turn><turn>assistant<text></turn>"
    assert [(a.turn, a.place, a.kind, a.uri, a.tokens) for a in one.attachments] == [
        (0, 1, "image", "s3://a", 3), (0, 2, "audio", "b", 26), (0, 3, "document", "c", 1200), (0, 4, "image", None, 1)]
    assert one.n_tokens_expanded == 1230 and two.attachments == [] and two.formatted == "<turn>user<text></turn>"


def test_digests(spark):
    from conftest import SF

    from tablecontract.llm.queries import op5_chat

    said = "</s>[INST] ok [/INST]"
    row = op5_chat(spark, SF).where("conv_id = -1").first()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
