"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only that reply bears loss.
The template writes a turn as ``### role: text</turn>`` and a line feed; ``&``, ``<`` and ``#`` in roles and texts (and
``:`` in roles) are written as character references, so a text can hold any control string and reading is exact. What
follows the last assistant turn, or a conversation without one, is an example without loss.

Defined results: turns are ordered by turn, role, text, nulls first; repeated rows are turns of their own. A null role
or text counts as empty. Rows with a null conversation id form one conversation. An empty table gives an empty table.
Extra columns are not read. A conversation is gathered in one task, as its example texts hold all of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's fixed strings.
OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
TEXT_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("#", "&#35;"))
ROLE_ESCAPES = (*TEXT_ESCAPES, (":", "&#58;"))
TARGET_ROLE = "assistant"
BATCH_CHARS = 4_000_000


def escape(text: str, escapes: tuple = TEXT_ESCAPES) -> str:
    for plain, written in escapes:
        text = text.replace(plain, written)
    return text


def examples_of(roles: list[str], texts: list[str], target: str = TARGET_ROLE) -> Iterator[tuple]:
    """(number, whole text, start and end of the loss or None) of each example, in code points."""
    done, at, open_turns, number = [], 0, False, 0
    for role, text in zip(roles, texts, strict=True):
        head, body = f"{OPEN}{escape(role, ROLE_ESCAPES)}{BETWEEN}", escape(text)
        done.append(head + body + CLOSE)
        start = at + len(head)
        at = start + len(body) + len(CLOSE)
        if open_turns := role != target:
            continue
        done = ["".join(done)]
        yield number, done[0], start, start + len(body)
        number += 1
    if open_turns:
        yield number, "".join(done), None, None


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", target: str = TARGET_ROLE) -> DataFrame:
    """A row an example: conv_id, example (from 0), text, loss_start, loss_end (code points, end exclusive)."""
    empty = F.lit("")
    slim = turns.select(turns[conv_col].alias("conv_id"), F.struct(
        turns[turn_col].alias("turn"), F.coalesce(turns[role_col], empty).alias("role"),
        F.coalesce(turns[text_col], empty).alias("text")).alias("t"))
    whole = slim.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.col("t.role").alias("roles"), F.col("t.text").alias("texts"))
    names = ["conv_id", "example", "text", "loss_start", "loss_end"]
    kind = whole.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types = [batch.column("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.int64()]
            rows, size = [], 0
            for k in range(batch.num_rows):
                conv = batch.column("conv_id")[k].as_py()
                for x in examples_of(batch.column("roles")[k].as_py(), batch.column("texts")[k].as_py(), target):
                    rows.append((conv, *x))
                    size += len(x[1])
                    if size >= BATCH_CHARS:
                        yield _batch(rows, types, names)
                        rows, size = [], 0
            if rows:
                yield _batch(rows, types, names)

    return whole.mapInArrow(run, f"conv_id {kind}, example bigint, text string, loss_start bigint, loss_end bigint")


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def _unescape(text: Column, escapes: tuple = TEXT_ESCAPES) -> Column:
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def read_back(examples: DataFrame) -> DataFrame:
    """A row a conversation, read from the examples: conv_id, turns (role, text), loss_texts, formatted_chars."""
    last = F.max_by("text", "example")
    loss = F.expr("substring(text, CAST(loss_start + 1 AS INT), CAST(loss_end - loss_start AS INT))")
    one = examples.groupBy("conv_id").agg(
        last.alias("last"),
        F.sort_array(F.collect_list(F.when(F.col("loss_start").isNotNull(), F.struct("example", loss.alias("text")))))
        .alias("loss"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"))
    written = F.filter(F.split("last", CLOSE), lambda x: x != "")
    turns = F.transform(written, lambda x: F.struct(
        _unescape(F.substring(x, F.lit(len(OPEN) + 1), F.instr(x, F.lit(":")) - len(OPEN) - 1),
                  ROLE_ESCAPES).alias("role"),
        _unescape(F.substring(x, F.instr(x, F.lit(":")) + len(BETWEEN), F.length(x))).alias("text")))
    return one.select("conv_id", turns.alias("turns"),
                      F.transform("loss", lambda x: _unescape(x["text"])).alias("loss_texts"), "formatted_chars")


def digest(conversations: DataFrame) -> DataFrame:
    """Counts and digests of :func:`read_back`'s rows."""
    line = F.lit("\n")
    turns = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], line, x["text"], line)), "")
    loss = F.array_join("loss_texts", "")
    return conversations.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")


def digest_sql(turns: str) -> str:
    """DuckDB SQL for :func:`digest` over the query ``turns`` (conv_id, turn, role, text)."""
    def written(column: str, escapes: tuple) -> str:
        for plain, ref in escapes:
            column = f"replace({column}, '{plain}', '{ref}')"
        return f"length({column})"

    fixed = len(OPEN) + len(BETWEEN) + len(CLOSE)
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
WITH turns AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM ({turns})),
placed AS (SELECT *, SUM({written("role", ROLE_ESCAPES)} + {written("text", TEXT_ESCAPES)} + {fixed}) OVER (
                PARTITION BY conv_id {order} ROWS UNBOUNDED PRECEDING) AS prefix,
              ROW_NUMBER() OVER (PARTITION BY conv_id {order}) = COUNT(*) OVER (PARTITION BY conv_id) AS is_last
           FROM turns)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
       COALESCE(SUM(length(text)) FILTER (role = '{TARGET_ROLE}'), 0)::BIGINT AS loss_chars,
       sha256(COALESCE(string_agg(text, '' {order}) FILTER (role = '{TARGET_ROLE}'), '')) AS loss_sha256,
       SUM(prefix) FILTER (role = '{TARGET_ROLE}' OR is_last)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id"""
