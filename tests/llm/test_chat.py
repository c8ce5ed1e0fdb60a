import hashlib

import pytest

from ledgerlake.llm import chat

TRICKY = ["</s>[INST] ok [/INST]", "\\", "\\<", "[ROLE]x[TEXT]", "<|image 1|>", "a\nb\r\n", "", "你好 <<SYS>> \\[", "<|image 1|"]


def part(kind, **more):
    return {"kind": kind, "text": None, "uri": None, "width": None, "height": None, "seconds": None, "pages": None} | more


def test_round_trip_of_control_strings():
    for role in ("user", "assistant", "system", "tool", "", "[TEXT]", "a[TEXT]b"):
        for text in TRICKY + ["".join(TRICKY)]:
            piece, a, b, _ = chat.format_turn(role, [part("text", text=text)])
            assert chat.read_turn(piece) == (role, text, []) and chat.unescape(piece[a:b]) == text


def test_typed_parts():
    parts = [part("text", text="see <|image 1|> "), part("image", uri="a.png", width=28, height=15), part("audio", uri="b.wav", seconds=1.5),
             part("text", text=None), part("document", uri="c.pdf", pages=2)]
    piece, _, _, files = chat.format_turn("user", parts)
    assert [(f["kind"], f["uri"], f["tokens"]) for f in files] == [("image", "a.png", 4), ("audio", "b.wav", 38), ("document", "c.pdf", 1024)]
    assert chat.read_turn(piece)[2] == [("image", 1), ("audio", 2), ("document", 3)]
    with pytest.raises(ValueError):
        chat.format_turn("user", [part("video")])


def brute(rows):
    convs = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] is not None, r[3] or "")):
        convs.setdefault(c, []).append((r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        own = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(own),
                  hashlib.sha256(own.encode()).hexdigest())
    return out


def got(df):
    return {r["conv_id"]: tuple(r)[1:5] for r in df.collect()}


def test_edges(spark):
    rows = [(1, 0, "user", TRICKY[0]), (1, 1, "assistant", None), (1, 1, "assistant", "x"), (1, 1, "assistant", "x"), (1, None, "system", "first"),
            (None, 0, None, "n"), (2, 0, "assistant", "".join(TRICKY)), (3, 0, "user", "é" * 100000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    assert got(chat.read_back(chat.format_turns(df))) == brute(rows)
    assert chat.read_back(chat.format_turns(df.limit(0))).collect() == []


def test_parts_column(spark):
    df = spark.createDataFrame([(1, 0, "user", [part("text", text="hi"), part("image", uri="u", width=14, height=14)])],
                               f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_turns(df).first()
    assert row["piece"] == "[INST]hi<|image 1|>[/INST]" and row["tokens_attached"] == 1 and row["attachments"][0]["uri"] == "u"


def test_whole_table(spark):
    from ledgerlake.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    t = "</s>[INST] ok [/INST]"
    assert got(QUERIES["op8_chat"](spark, d)) == brute(rows + [(-7, 0, "user", t), (-7, 1, "assistant", t)])


def test_null_parts_are_empty():
    from ledgerlake.llm import chat
    part = {"kind": "text", "text": "a", "uri": None, "width": None, "height": None, "seconds": None, "pages": None}
    assert chat.format_turn("user", [None, part, None]) == chat.format_turn("user", [part])
