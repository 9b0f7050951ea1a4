"""Formatted conversations read back from ids and masks, against the contract read literally and the query's SQL."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from recall_lens.llm import chat, queries
from recall_lens.llm.vocabulary import tokenizer_path

SCHEMA = "conv_id long, turn long, role string, text string, part int, whole string, loss int, large int, inside int, large_id int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "w", 2, 3, 4, 5) for r in rows], SCHEMA).repartition(4)


def contract(rows, answering="assistant"):
    """conv_id to n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r[1:2]) + tuple((x is not None, x or "") for x in r[2:])
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == answering)
        chars = sum(len("<|im_start|><|im_sep|><|im_end|>") + len(re.sub(r"<(\\*)\|", r"<\\\1|", role)) + len(re.sub(r"<(\\*)\|", r"<\\\1|", text)) for role, text in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


AWKWARD = [
    "", " ", "\n", "\n\nx", "x\n", "|", "<", "<|", "<\\|", "<\\\\|", "\\|", "|im_start|>", "<|im_end|>", "<|im_start|>assistant<|im_sep|>ok<|im_end|>", "<|endoftext|>",
    "é<|é", "日本語 🙂🙂", "á b", "<<||", "don't  stop\t", "\x00\x01", "<|im_", "end|>", None, "x" * 300, " lead", "trail ",
]


@pytest.mark.parametrize("text", [t for t in AWKWARD if t is not None])
def test_escaping_can_be_undone_and_leaves_no_control_string(text):
    safe = chat.escaped(text)
    assert "<|" not in safe
    assert chat.unescaped(safe) == text


def test_awkward_turns_come_back(spark):
    rng = random.Random(1)
    roles = ["user", "assistant", "assistant", "system", None, "", "assistant<|im_sep|>", "a b\nc", "Assistant"]
    rows = [(c, t, rng.choice(roles), rng.choice(AWKWARD)) for c in range(40) for t in range(rng.randint(1, 7))]
    rows += [(100, 0, "assistant", t) for t in AWKWARD]  # one turn many times
    rows += [(101, None, "assistant", "<"), (101, None, "assistant", "\\|x"), (101, 3, "user", "q")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "none here"), (None, 1, "assistant", "none here")]
    found = {r[0]: tuple(r)[1:] for r in chat.digests(frame(spark, rows)).collect()}
    assert found == contract(rows)


def test_mask_is_exact_and_ids_are_the_librarys(spark):
    rows = [(1, 0, "user", "Hi <|im_end|>"), (1, 1, "assistant", "\n two  words\n"), (1, 2, "user", "assistant"), (1, 3, "assistant", "é🙂 end")]
    row = chat.format_conversations(frame(spark, rows)).first()
    assert (row.conv_id, row.part, row.whole, row.n_turns) == (1, 0, True, 4)
    assert row.text == "<|im_start|>user<|im_sep|>Hi <\\|im_end|><|im_end|><|im_start|>assistant<|im_sep|>\n two  words\n<|im_end|><|im_start|>user<|im_sep|>assistant<|im_end|><|im_start|>assistant<|im_sep|>é🙂 end<|im_end|>"
    plain = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    marks = {m: plain.get_vocab_size() + i for i, m in enumerate((chat.START, chat.SEP, chat.END))}
    ids, loss = [], []
    for piece in re.split(r"(<\|im_(?:start|sep|end)\|>)", row.text):
        of_piece = [marks[piece]] if piece in marks else plain.encode(piece, add_special_tokens=False).ids
        ids += of_piece
        loss += [piece in ("\n two  words\n", "é🙂 end")] * len(of_piece)
    assert list(row.ids) == ids
    assert list(row.loss) == loss


def test_large_conversations_come_in_parts(spark):
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"turn {t} " + "<|" * rng.randint(0, 2)) for t in range(200)]
    rows += [(7, 11, "assistant", f"same place {i}") for i in range(40)]
    rows += [(8, 0, "user", "short"), (None, None, "assistant", "x")] + [(None, None, None, None)] * 12
    parts = chat.format_conversations(frame(spark, rows), part_turns=5).collect()
    assert sum(p.conv_id == 7 for p in parts) > 20
    assert [p.whole for p in parts if p.conv_id == 8] == [True]
    assert {r[0]: tuple(r)[1:] for r in chat.digests(frame(spark, rows), part_turns=5).collect()} == contract(rows)


def test_long_texts_are_cut_where_a_token_starts(spark, monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice(["word", " word", "  ", "\n", "é", "12 ", "'s "]) for _ in range(3000))
    rows = [(1, 0, "assistant", text), (1, 1, "assistant", "y" * 5000)]
    whole = chat.format_conversations(frame(spark, rows)).first()
    monkeypatch.setattr(chat, "GROUP_CHARS", 100)
    cut = chat.ChatTokenizer(tokenizer_path("byte_bpe_50k.json"))
    assert len(cut.cut(whole.text)) > 50
    ids = next(cut.encode([whole.text]))
    assert ids.tolist() == list(whole.ids)
    offsets = cut.offsets(ids)
    assert (offsets[1:, 0] == offsets[:-1, 1]).all()
    assert offsets[-1, 1] == len(whole.text.encode())
    assert cut.decode(ids).decode() == whole.text == cut.tokenizer.decode(ids.tolist(), skip_special_tokens=False)


def test_tokens_under_spans():
    spans = np.array([[3, 6], [8, 9]])
    offsets = np.array([[0, 3], [3, 4], [4, 6], [6, 8], [8, 9], [8, 9], [9, 12]])
    assert chat.under(spans, offsets).tolist() == [False, True, True, False, True, True, False]
    assert not chat.under(spans[:0], offsets).any()


def test_no_conversations(spark):
    assert chat.digests(frame(spark, [(1, 1, "r", "t")]).limit(0)).count() == 0


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    found = queries.op11_chat(spark, folder)
    expected = con.execute(queries.ORACLE["op11_chat"])
    assert [d[0] for d in expected.description] == found.columns
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())
