"""Chat texts against a plain version: what is read back, the mask, and the texts themselves."""

from __future__ import annotations

import hashlib
import re

import pytest

from uptake.llm.chat_format import CONTROLS, format_chats, plain_role, plain_text, read_chats

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part string, id string, block int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """Per conversation the formatted text, its loss ranges, and the digests."""
    convs = {}
    for conv, turn, role, text, *_ in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        whole, loss = "", []
        turns.sort(key=lambda t: (*t[:2], t[2].encode(), t[3].encode() + b"\n"))
        for _, _, role, text in turns:
            for c in CONTROLS:
                text = re.sub(f"({re.escape(c[0])})(\\\\*{re.escape(c[1:])})", r"\1\\\2", text)
            line = role.replace("\\", "\\\\").replace("\n", "\\n")
            line = line.replace("<", "\\l").replace("[", "\\b")
            whole += f"<|im_start|>{line}\n"
            if role == "assistant":
                loss.append((len(whole), len(whole) + len(text)))
            whole += f"{text}<|im_end|>\n"
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        digests = (len(turns), sha(said), len(learned), sha(learned), len(whole))
        out[conv] = (whole, loss, digests)
    return out


CONTROL_TEXTS = [
    "".join(CONTROLS), "<\\s>", "<\\\\\\s> <s", "[[INST]] [\\/INST] [\\\\", "<<SYS>><</SYS>>", "<",
    "<|im_end|", "\\", "<|im_start|>user\nhi<|im_end|>\n", "é<s>漢[INST]字", "\n", "SYS>>", "s>",
]


def odd_rows():
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(CONTROL_TEXTS)]
    rows += [(2, None, "user", "first"), (2, 5, None, None), (2, 5, None, None), (2, 5, "a", "z")]
    rows += [(2, 5, "a", "y"), (2, -1, "assistant", ""), (3, 0, "<s>\n[INST]\\n", "x<")]
    rows += [(None, 1, "assistant", "nobody"), (None, None, "user", "né")]
    rows += [(4, 0, "assistant", "<s> long é " * 200_000), (4, 1, "user", ""), (5, 0, "", "")]
    return [(*r, "p", None, 7) for r in rows]


def formatted(parts):
    """Conversations from their parts, with loss ranges of the whole."""
    texts = {}
    rows = [r for some in parts if some is not None for r in some.collect()]
    for r in sorted(rows, key=lambda r: (r["block"], r["part"])):
        whole, loss = texts.setdefault(r["id"], ("", []))
        loss += [(s["start"] + len(whole), s["end"] + len(whole)) for s in r["loss"]]
        texts[r["id"]] = (whole + r["text"], loss)
    return texts


@pytest.mark.parametrize("part_bytes, long_turns", [(1 << 20, 1 << 16), (40, 1 << 16), (300, 4)])
def test_texts_mask_and_digests(spark, part_bytes, long_turns):
    rows = odd_rows() + [(6, i, "assistant", f"turn {i}", "", "", 0) for i in range(9000, 0, -1)]
    df = spark.createDataFrame(rows, SCHEMA)
    parts = format_chats(df, part_bytes=part_bytes, long_turns=long_turns)
    assert (parts[1] is not None) == (long_turns == 4)
    expected = brute(rows)
    assert formatted(parts) == {c: x[:2] for c, x in expected.items()}
    read = {r["id"]: tuple(r)[1:] for r in read_chats(*parts).collect()}
    assert read == {c: x[2] for c, x in expected.items()}


def test_escapes_are_reversible_and_leave_no_control_string():
    for text in CONTROL_TEXTS:
        for depth in range(4):
            (whole, _, _), = brute([(0, 0, "user", text)]).values()
            body = whole.removeprefix("<|im_start|>user\n").removesuffix("<|im_end|>\n")
            assert not any(c in body for c in CONTROLS)
            assert plain_text(body.encode()).decode() == text
            text = body
    assert plain_role("\\\\n\\n\\l\\b") == "\\n\n<["


def test_no_rows(spark):
    parts = format_chats(spark.createDataFrame([], SCHEMA))
    assert parts[1] is None and read_chats(*parts).collect() == []
