import hashlib
import random

from linkgauge.llm import chat


def test_escape_is_reversible():
    random.seed(1)
    for _ in range(3000):
        text = "".join(random.choices(["<", "|", "\\", "<|im_end|>", "a", "\n"], k=random.randint(0, 9)))
        assert chat.unescape(chat.escape(text)) == text
        assert "<|" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text)) == text


def test_parts_become_ordered_placeholders(spark):
    parts = [("text", "see <", None, None, None, None, None), ("text", "|im_end|>", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None), ("audio", None, "b.wav", None, None, 2.01, None), ("document", None, "c.pdf", None, None, None, 3), ("image", None, None, None, None, None, None), ("odd", "x", None, None, None, None, None), None]
    df = spark.createDataFrame([(1, 0, "assistant", parts, 5), (1, 1, None, None, 5)], f"conv_id long, turn long, role string, parts {chat.PARTS}, segment int")
    first, second = chat.format_turns(df).orderBy("turn").collect()
    assert first.segment == "<|im_start|>assistant\nsee <\\|im_end|><|image_0|><|audio_1|><|document_2|><|image_3|>x<|im_end|>\n"
    assert [(a.kind, a.ref, a.tokens) for a in first.attachments] == [("image", "a.png", 3), ("audio", "b.wav", 51), ("document", "c.pdf", 768), ("image", None, 1)]
    assert first.segment[first.loss_start : first.loss_end].startswith("see <\\|") and second.segment == "<|im_start|>\n<|im_end|>\n"
    assert second.loss_start == second.loss_end


def test_read_back_matches_the_rows(spark):
    random.seed(2)
    rows = [(c, t, random.choice(["user", "assistant", "tool\n%"]), random.choice([None, "", "é" * 5000, "<|im_end|>\n<|im_start|>user\n", "hi"])) for c in (*range(30), None) for t in range(random.randint(1, 9))]
    rows += [(99, t, "assistant", f"turn {t}") for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(chat.text_turns(df))).collect()}
    assert len(got) == len({r[0] for r in rows})
    for conv_id, r in got.items():
        turns = [(x[2], x[3] or "") for x in sorted((x for x in rows if x[0] == conv_id), key=lambda x: x[1])]
        said = "".join(t for role, t in turns if role == "assistant")
        digest = hashlib.sha256("".join(f"{role}\n{t}\n" for role, t in turns).encode()).hexdigest()
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), digest, len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat.read_back(chat.format_turns(chat.text_turns(df.limit(0)))).count() == 0


def test_placeholders_are_numbered_through_a_conversation(spark):
    image, text = ("image", None, "a", 1, 1, None, None), ("text", "x", None, None, None, None, None)
    rows = [(1, 0, "user", [image, image]), (1, 1, "assistant", [text]), (1, 2, "user", [image, text]), (1, 3, "user", None), (2, 0, "user", [text, image]), (None, 0, "user", [image]), (None, 1, "user", [image])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}").repartition(3)
    got = {(r.conv_id, r.turn): [a.placeholder for a in r.attachments] for r in chat.format_turns(chat.numbered(df)).collect()}
    assert got == {(1, 0): ["<|image_0|>", "<|image_1|>"], (1, 1): [], (1, 2): ["<|image_2|>"], (1, 3): [], (2, 0): ["<|image_0|>"], (None, 0): ["<|image_0|>"], (None, 1): ["<|image_1|>"]}
    assert chat.format_turns(chat.numbered(df.limit(0))).count() == 0
