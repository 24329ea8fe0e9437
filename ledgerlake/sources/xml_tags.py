"""Which record tags XML documents hold: the root's direct children, found at any document size.

Spark splits the documents into blocks at ``>``, so a row has at most one tag. A task that reads a block does not know
how deep it starts, nor whether inside a comment, so it summarises the block for each possible state at its start:
the state at its end, the change of depth, and the tags that open at each relative depth. The summaries of one file
(a few rows a block) are then joined in order. Only distinct tags reach the driver.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# States: in the content, in a comment, CDATA section, processing instruction or document type, or in a value of a tag
# that the named quote began.
CONTENT, COMMENT, CDATA, INSTRUCTION, DOCTYPE = "content", "comment", "cdata", "instruction", "doctype"
QUOTES = ("'", '"')
_ENDS = {COMMENT: "--", CDATA: "]]", INSTRUCTION: "?", DOCTYPE: "]"}
_NAME = re.compile(r"[^\s/>]+")


def _open_quote(text: str, quote: str = "") -> str:
    """The quote that is open after a part of a tag, if any; ``quote``: the one open before it."""
    at = 0
    while True:
        if quote:
            at = text.find(quote, at) + 1
            if not at:
                return quote
            quote = ""
        else:
            found = [k for q in QUOTES if (k := text.find(q, at)) >= 0]
            if not found:
                return ""
            at = min(found) + 1
            quote = text[at - 1]


class _Walk:
    """Follows one block from one state. A tag counts from its first piece on, so that a block may end inside it."""

    def __init__(self, state: str) -> None:
        self.start = self.state = state
        self.depth = 0
        self.opened: set[tuple[int, str]] = set()

    def feed(self, piece: str) -> None:
        """The text up to a ``>``."""
        if self.state in QUOTES:
            self._end_tag(piece, self.state)
        elif self.state != CONTENT:
            if piece.rstrip().endswith(_ENDS[self.state]) if self.state == DOCTYPE else piece.endswith(_ENDS[self.state]):
                self.state = CONTENT
        elif (at := piece.find("<")) >= 0:
            tag = piece[at + 1:]
            if tag.startswith("!--"):
                self._open_to(COMMENT, tag[3:])
            elif tag.startswith("![CDATA["):
                self._open_to(CDATA, tag[8:])
            elif tag.startswith("?"):
                self._open_to(INSTRUCTION, tag[1:])
            elif tag.startswith("!"):
                if "[" in tag and not tag.rstrip().endswith("]"):
                    self.state = DOCTYPE
            elif tag.startswith("/"):
                self.depth -= 1
            elif name := _NAME.match(tag):
                self.opened.add((self.depth, name[0]))
                self.depth += 1
                self._end_tag(tag)

    def _end_tag(self, text: str, quote: str = "") -> None:
        """A further part of a tag: its end unless a value is still open."""
        self.state = _open_quote(text, quote) or CONTENT
        if self.state == CONTENT and text.endswith("/"):
            self.depth -= 1

    def _open_to(self, state: str, rest: str) -> None:
        if not rest.endswith(_ENDS[state]):
            self.state = state


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    walks: dict[tuple[str, int], list[_Walk]] = {}
    for batch in batches:
        for (file, block), rows in batch.groupby(["file", "block"], sort=False):
            own = walks.setdefault((file, block), [_Walk(s) for s in (CONTENT, *_ENDS, *QUOTES)])
            for piece in rows["value"]:
                for walk in own:
                    walk.feed(piece)
    yield pd.DataFrame(
        [(file, block, w.start, w.state, w.depth, json.dumps(sorted(w.opened)))
         for (file, block), own in walks.items() for w in own],
        columns=["file", "block", "before", "after", "depth", "opened"])


def _join_blocks(blocks: pd.DataFrame) -> pd.DataFrame:
    """(depth, tag) of one file, from its blocks' summaries."""
    state, depth, found = CONTENT, 0, set()
    by_block = blocks.set_index(["block", "before"])
    for block in sorted(set(blocks["block"])):
        row = by_block.loc[(block, state)]
        found |= {(depth + d, tag) for d, tag in json.loads(row["opened"])}
        state, depth = row["after"], depth + int(row["depth"])
    roots = sorted(tag for d, tag in found if d == 0)
    return pd.DataFrame([(roots[0] if roots else None, min(d, 2), tag) for d, tag in found],
                        columns=["root", "depth", "tag"]).drop_duplicates()


def tags_by_depth(spark: SparkSession, path: str) -> DataFrame:
    """(root, depth, tag) over all documents under ``path``: 0 the root, 1 its children, 2 anything below."""
    pieces = spark.read.option("lineSep", ">").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    blocks = pieces.mapInPandas(_summaries, "file string, block long, before string, after string, depth long, "
                                            "opened string")
    return blocks.groupBy("file").applyInPandas(_join_blocks, "root string, depth int, tag string").distinct()


def record_tags(spark: SparkSession, path: str, root_tag: str | None = None) -> list[str]:
    """The tags of the roots' direct children, in all documents or in those with the root ``root_tag``.

    Raises ``ValueError`` where no document has an element, and where a record's tag also occurs at another depth, so
    that reading all elements of that name would give more than the records.
    """
    found = [tuple(r) for r in tags_by_depth(spark, path).collect()]  # distinct tags: a schema's size
    if not any(depth == 0 for _, depth, _ in found):
        raise ValueError(f"no XML element in {path}")
    wanted = sorted({tag for root, depth, tag in found if depth == 1 and root_tag in (None, root)})
    elsewhere = sorted({tag for _, depth, tag in found if depth != 1} & set(wanted))
    if elsewhere:
        raise ValueError(f"{', '.join(elsewhere)}: record tags that also occur at another depth; name the row_tags")
    return wanted
