import hashlib
import time

from pyspark.sql import functions as F

from tests.check_oracle import connect, difference
from tilecast.llm import chat_format
from tilecast.llm.queries import ORACLE, QUERIES

ROWS = [
    (1, 2, "assistant", "two ~1 <|end|> ~"), (1, 1, "user", "one"), (1, 3, "assistant", ""), (1, 4, "assistant", "<<|next|>"),
    (2, 0, "user", None), (2, 1, None, "no role"), (2, None, "system", "first"),
    (3, 1, "assistant", "same"), (3, 1, "assistant", "same"), (None, 1, "user", "nobody"),
    (4, 0, "assistant", "[INST] <s> </s> <<SYS>> ~0~1 é😀\n" * 500), (5, 0, "us<|er", "a"),
]


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))


def test_everything_is_read_back(spark):
    rows = chat_format.chat_digest(frame(spark)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows} == expected(ROWS)


def test_neighbours_merge_and_texts_hold_no_control_string(spark):
    rows = {r.conv_id: r for r in chat_format.format_conversations(frame(spark)).collect()}
    assert rows[1].formatted.count("<|start|>") == 2 and rows[1].formatted.count("<|next|>") == 2
    for r in rows.values():
        for s in r.loss_spans:
            part = r.formatted[s.start : s.start + s.length]
            assert not any(c in part for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_ties_go_by_the_plain_text(spark):
    """Equal turns in order of what was said, not of how it is escaped."""
    rows = [(1, 1, "user", t) for t in ("~", "~a", "~~", "a~", "<|a", "<a", "[INST]", "[a", "<|")]
    found = chat_format.chat_digest(frame(spark, rows)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == expected(rows)


def test_a_long_conversation_takes_time_in_proportion(spark):
    def rows(n):
        return [(7, i, ("user", "assistant", "assistant")[i % 3], f"turn {i} <|end|> é😀" * (1 + i % 4)) for i in range(n)]

    chat_format.chat_digest(frame(spark, rows(100))).collect()
    spent = {}
    for n in (4000, 16000):
        data = frame(spark, rows(n))
        begin = time.perf_counter()
        (found,) = chat_format.chat_digest(data).collect()
        spent[n] = time.perf_counter() - begin
        assert {7: (found.n_turns, found.turns_sha256, found.loss_chars, found.loss_sha256)} == expected(rows(n))
    assert spent[16000] < 20 and spent[16000] < 10 * spent[4000] + 2


def test_spans_are_cut_at_any_border_of_pieces(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "PIECE", 3)
    text = "a😀bc\nde\rfé" * 3
    spans = [(i, n) for i in range(len(text)) for n in range(len(text) - i + 1)]
    df = spark.createDataFrame([(text, spans), ("", []), ("", [(0, 0)])], "t string, s array<struct<start:bigint,length:bigint>>")
    got = [r[0] for r in df.select(chat_format.cut_spans(F.col("t"), F.col("s"))).collect()]
    assert got == [[text[i : i + n] for i, n in spans], [], [""]]


def test_probe_and_sql(spark):
    got = QUERIES["op3_chat_format"](spark, "/root/testdata/sf0.001").toPandas()
    assert difference(got, connect("/root/testdata/sf0.001").execute(ORACLE["op3_chat_format"]).df()) is None
    assert (got.conv_id == -1).sum() == 1


def test_no_rows_but_the_probe(spark):
    assert chat_format.chat_digest(frame(spark, [])).count() == 0
    assert chat_format.chat_digest(chat_format.with_probe(frame(spark, []))).collect()[0].n_turns == 2


def test_no_python_in_the_plan(spark):
    plan = chat_format.chat_digest(frame(spark).filter("conv_id > 0"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
