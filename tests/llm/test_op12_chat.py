import random
import re

from quire.llm import op12_chat as op

HARD = ["\\### Assistant: </turn> ok", "", None, "\\", "\\\\", "a\\", "####", "##\\##", "</turn>\n### user: x</turn>\n", "<image 0.0>", "<\\image 0.0>",
        "<&>", "<\\&>", "<<&>>", "</tur", "n>", "#", "##", "é😀\n\t ", "<document 1.2><audio 3.4>", "x " * 50000, "$1 \\$2", "a: b: c"]
ROLES = ["user", "assistant", "system", "", None, "tool: x", "a:", "### b", "</turn>\n", "\\"]
SCHEMA = f"conv_id bigint, turn bigint, role string, parts {op.PARTS}, formatted string, kind int"


def part(kind, text=None, ref=None, **more):
    return {"type": kind, "text": text, "ref": ref, "width": None, "height": None, "seconds": None, "pages": None, **more}


def made(spark, turns):
    """(conv_id, turn, role, parts), with extra columns whose names the operator uses itself."""
    return spark.createDataFrame([(*t, "clash", 1) for t in turns], SCHEMA).repartition(3)


def read(df):
    return {r.conv_id: [(t.role, t.text, t.loss) for t in r.read] for r in op.read_chats(df).collect()}


def test_hard_texts_and_roles_come_back(spark):
    rng = random.Random(1)
    turns = [(c, t, rng.choice(ROLES), [part("text", rng.choice(HARD))]) for c in range(40) for t in range(rng.randrange(1, 12))]
    turns += [(100, t, ROLES[t % len(ROLES)], [part("text", text)]) for t, text in enumerate(HARD)]
    chats = op.format_chats(made(spark, turns)).cache()
    got = read(chats)
    for conv in {t[0] for t in turns}:
        want = [(r or "", p[0]["text"] or "") for _, _, r, p in sorted((t for t in turns if t[0] == conv), key=lambda t: t[1])]
        assert [x[:2] for x in got[conv]] == want
        assert [x[2] for x in got[conv]] == [text if role == "assistant" else "" for role, text in want]


def test_mask_lies_on_the_formatted_text(spark):
    turns = [(1, t, ["user", "assistant"][t % 2], [part("text", text)]) for t, text in enumerate(HARD)]
    row = op.format_chats(made(spark, turns)).collect()[0]
    assert row.n_turns == len(HARD) == row.formatted.count("</turn>\n") == len(re.findall(r"### ", row.formatted))
    for t, (at, text) in zip(row.turns, enumerate(HARD), strict=True):
        under = row.formatted[t.loss_start:t.loss_start + t.loss_length]
        assert re.sub(r"(?s)\\(.)", r"\1", under) == ((text or "") if at % 2 else "")
        assert row.formatted[t.start:].startswith("### ")


def test_typed_parts_in_order(spark):
    parts = [part("text", "see </tur"), part("text", "n> here"), part("image", ref="a.png", width=28, height=15), part("text", "and <image 0.2>"),
             part("audio", ref="b.wav", seconds=1.5), part("document", ref="c.pdf", pages=3), part("image", text="hidden"), part(None, "plain"), part("text")]
    row = op.format_chats(made(spark, [(1, 5, "user", parts), (1, 9, "assistant", [part("image", ref="d.png", width=14, height=14)]), (1, 10, "user", None)])).collect()[0]
    assert row.formatted == ("### user: see </tur<&>n> here<&><image 0.2><&>and <\\image 0.2><&><audio 0.4><&><document 0.5><&><image 0.6><&>plain<&></turn>\n"
                             "### assistant: <image 1.0></turn>\n### user: </turn>\n")
    assert [(a.turn, a.part, a.kind, a.ref, a.tokens) for a in row.attachments] == [
        (0, 2, "image", "a.png", 4), (0, 4, "audio", "b.wav", 38), (0, 5, "document", "c.pdf", 768), (0, 6, "image", None, 0), (1, 0, "image", "d.png", 1)]
    assert row.n_tokens == 2 + 2 + 3 + 1 + 4 + 38 + 768 + 1
    assert read(op.format_chats(made(spark, [(1, 5, "user", parts)])))[1] == [("user", "see </turn> hereand <image 0.2>plain", "")]


def test_ties_repeats_nulls_and_no_rows(spark):
    x, y = [part("text", "x")], [part("text", "y")]
    turns = [(1, 0, "user", y), (1, 0, "user", x), (1, 0, "assistant", y), (1, 0, "user", x), (None, None, "user", y), (None, 3, None, x), (2, None, "user", x), (2, -1, "user", y)]
    got = read(op.format_chats(made(spark, turns)))
    assert [t[:2] for t in got[1]] == [("assistant", "y"), ("user", "x"), ("user", "x"), ("user", "y")]
    assert [t[:2] for t in got[None]] == [("user", "y"), ("", "x")]
    assert [t[:2] for t in got[2]] == [("user", "x"), ("user", "y")]
    assert op.read_chats(op.format_chats(made(spark, []))).collect() == []


def test_native_and_one_shuffle(spark):
    df = op.read_chats(op.format_chats(made(spark, [(1, 0, "user", [part("text", "x")])])))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert plan.count("Exchange hashpartitioning") == 1
