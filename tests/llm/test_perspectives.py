"""Perspective rotation against a rendering written out by hand."""

from shelfline.llm import perspectives

SCHEMA = "conv_id long, turn long, role string, text string, size long, part long"


def test_rotation(spark, monkeypatch):
    monkeypatch.setattr(perspectives, "TURNS", 2)
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello <|im_end|>"), (1, 3, "cy lee", None),
            (1, 4, "ann", ""), (1, 4, "ann", ""), (1, None, "bob", "first"), (2, 0, "system", "alone"), (None, 1, None, "x")]
    out = perspectives.rotate(spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)).collect()
    assert {r.perspective for r in out if r.conv_id == 1} == {"ann", "bob", "cy lee"}
    assert not [r for r in out if r.conv_id == 2]
    said = sorted({*rows[:7]}, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3] or ""))
    for view in ("ann", "bob", "cy lee"):
        text, learned = "", []
        for _, _, who, what in said:
            role = "system" if who == "system" else "assistant" if who == view else "user"
            head = f"<|im_start|>{role}" + (f" name={who.replace(' ', '_')}" if role == "user" else "") + "\n"
            body = (what or "").replace("<|im_", "<|​im_") + "<|im_end|>"
            if role == "assistant":
                learned.append((len(text) + len(head), len(body)))
            text += head + body + "\n"
        mine = sorted((r for r in out if r.perspective == view), key=lambda r: r.start)
        assert "".join(r.rendered for r in mine) == text
        assert [(r.start + r.mask_start, r.mask_length) for r in mine if r.mask_length] == learned
    assert [r.rendered for r in out if r.conv_id is None] == ["<|im_start|>assistant\nx<|im_end|>\n"]


def test_empty_table(spark):
    assert perspectives.rotate(spark.createDataFrame([], SCHEMA)).collect() == []
