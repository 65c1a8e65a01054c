import hashlib

from hypothesis import given
from hypothesis import strategies as st

from emberfold.llm import chat_parts as cp

PIECES = st.lists(st.sampled_from([*cp.CONTROLS, "\\", "a", "\n", "[", "<", "/ROLE]", "s>", "é"]), max_size=12).map("".join)


@given(PIECES)
def test_escaping_is_reversible_and_leaves_no_control(text):
    safe = cp.escape(text)
    assert cp.unescape(safe) == text
    assert not any(c in safe for c in cp.CONTROLS)


@given(st.lists(st.tuples(PIECES, PIECES), max_size=5))
def test_turns_are_read_back(turns):
    text = "".join(cp.format_turn(r, [{"kind": "text", "text": t}])["formatted"] for r, t in turns)
    assert cp.read_turns(text) == turns


def part(kind, **values):
    return {c: None for c in ("text", "ref", "width", "height", "seconds", "pages")} | {"kind": kind} | values


def test_attachments_keep_order_place_and_tokens():
    parts = [
        part("text", text="see [IMAGE] "), part("image", ref="a.png", width=57, height=28), part("audio", ref="b.wav", seconds=1.0),
        part("text", text="and"), part("document", ref="c.pdf", pages=2), part("video", ref="d"), part("image", ref="e"),
    ]
    out = cp.format_turn("assistant", parts)
    found = [(a["kind"], a["ref"], a["tokens"]) for a in out["attachments"]]
    assert found == [("image", "a.png", 4), ("audio", "b.wav", 13), ("document", "c.pdf", 1024), ("video", "d", 1), ("image", "e", 1)]
    for a in out["attachments"]:
        mark = cp.PLACEHOLDERS.get(a["kind"], cp.PLACEHOLDERS["document"])
        assert out["formatted"][a["start"] :].startswith(mark)
    assert [cp.unescape(out["formatted"][a:b]) for a, b in out["loss"]] == ["see [IMAGE] ", "and"]
    assert cp.read_turns(out["formatted"]) == [("assistant", "see [IMAGE] and")]
    assert out["expanded_tokens"] == 4 + 13 + 1024 + 2


def test_digests_of_conversations(spark):
    rows = [(c, t, r, x) for c in (1, 2) for t, r, x in (
        (1, "assistant", "\\ </s>"), (0, "user", None), (2, "assistant", "é"), (2, "assistant", "é"), (3, None, "x"))]
    rows += [(None, 0, "user", "a"), (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").selectExpr("*", "1 AS loss", "2 AS parts")
    turns = cp.format_turns(cp.text_parts(df))
    got = {r.conv_id: r for r in cp.read_back(turns).collect()}
    assert set(got) == {1, 2, None, -7}
    order = [("user", ""), ("assistant", "\\ </s>"), ("assistant", "é"), ("assistant", "é"), ("", "x")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].n_turns == 5 and got[1].turns_sha256 == got[2].turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in order))
    assert got[1].loss_chars == 8 and got[1].loss_sha256 == sha("\\ </s>éé")
    assert got[-7].loss_sha256 == sha("</s>[INST] ok [/INST]") and got[None].loss_chars == 0
    assert got[1].formatted_chars == sum(len(r.formatted) for r in turns.collect() if r.conv_id == 1)
    assert cp.read_back(cp.format_turns(cp.text_parts(df.limit(0)))).count() == 0


def test_typed_parts_through_spark(spark):
    parts = [part("text", text="look"), part("image", ref="r", width=28, height=28)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id INT, turn INT, role STRING, parts ARRAY<{cp.PART}>")
    rows = {r.turn: r for r in cp.format_turns(df).collect()}
    assert rows[0].attachments[0].ref == "r" and rows[0].expanded_tokens == 2 and rows[1].loss == []


def test_null_parts_and_sizes_that_cannot_be_counted(spark):
    parts = [
        None, part("text", text="a"), part("audio", seconds=float("nan")), part("audio", seconds=float("inf")),
        part("audio", seconds=-1.0), part("image", width=-5, height=10), part("document", pages=10_000_000), part(None),
    ]
    turns = spark.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts array<{cp.PART}>")
    (row,) = cp.format_turns(turns).collect()
    assert [a.tokens for a in row.attachments] == [1, 1, 1, 1, 5_120_000_000, 1]
    assert row.expanded_tokens == 5_120_000_005
    assert [t for _, t in cp.read_turns(row.formatted)] == ["a"]


def test_all_kinds_through_the_functions_of_the_query(spark):
    parts = [
        part("text", text="see </s>"), part("image", ref="a.png", width=57, height=28), part("audio", ref="b.wav", seconds=1.0),
        part("document", ref="c.pdf", pages=2), part("text", text=" end"),
    ]
    turns = spark.createDataFrame([(1, 0, "assistant", parts)], f"conv_id long, turn long, role string, parts array<{cp.PART}>")
    out = cp.format_turns(turns)
    (row,) = out.collect()
    assert [(a.kind, a.ref) for a in row.attachments] == [("image", "a.png"), ("audio", "b.wav"), ("document", "c.pdf")]
    assert [row.formatted[a.start :].split("]")[0] for a in row.attachments] == ["[IMAGE", "[AUDIO", "[DOCUMENT"]
    (back,) = cp.read_back(out).collect()
    assert back.loss_chars == len("see </s> end")
    assert back.turns_sha256 == hashlib.sha256(b"assistant\nsee </s> end\n").hexdigest()
