"""Record tags of generic XML: the same at every block size, as a whole-document parser finds them."""

from __future__ import annotations

import random
import xml.etree.ElementTree as ET

import pandas as pd
import pytest

from ledgerlake.sources import xml_tags as X


def document(rng: random.Random) -> str:
    def value() -> str:
        text = "".join(rng.choice(["a", ">", "/", "=", "it", " ", "]]", "--", "'", '"']) for _ in range(rng.randint(0, 6)))
        q = rng.choice("'\"")
        return q + text.replace(q, "") + q

    def inner(depth: int) -> str:
        out = []
        for _ in range(rng.randint(0, 4 - depth)):
            kind = rng.random()
            if kind < 0.5:
                out.append(element(rng.choice(["b", "c", "d"]) if depth > 1 else rng.choice(["row", "item"]), depth))
            elif kind < 0.65:
                out.append("<!--" + rng.choice([" <b> ", "a > b <row/>", "it's", '"', "- >"]) + "-->")
            elif kind < 0.8:
                out.append("<![CDATA[" + rng.choice(["<b>", "x > y ]", "</row>", "'", ']] "']) + "]]>")
            elif kind < 0.9:
                out.append("<?go " + rng.choice(["a > b", "<b", "'"]) + "?>")
            else:
                out.append(rng.choice(["text", "it's", 'say "no"', "a > b", "\n"]))
        return "".join(out)

    def element(name: str, depth: int) -> str:
        attributes = "".join(f" {n}{rng.choice(['=', ' = '])}{value()}" for n in rng.sample("xyz", rng.randint(0, 3)))
        space = rng.choice(["", " ", "\n"])
        if rng.random() < 0.3:
            return f"<{name}{attributes}{space}/>"
        return f"<{name}{attributes}{space}>{inner(depth + 1)}</{name}{rng.choice(['', ' '])}>"
    head = rng.choice(["", "<?xml version='1.0'?>\n", '<?xml version="1.0"?><!-- <row> -->', "<!DOCTYPE top [\n<!ELEMENT b ANY>\n]>"])
    return head + f"<top{rng.choice(['', ' t=' + value()])}>{inner(0)}{inner(0)}</top>\n"


def truth(text: str) -> set[tuple[str, int, str]]:
    top = ET.fromstring(text.encode())
    out = {(top.tag, 0, top.tag)}

    def walk(e, depth):
        for child in e:
            out.add((top.tag, min(depth, 2), child.tag))
            walk(child, depth + 1)
    walk(top, 1)
    return out


def found(text: str, size: int) -> set[tuple[str, int, str]]:
    """As Spark deals a file out: pieces up to each ">", each in the block in which it starts."""
    pieces, at = [], 0
    for piece in text.split(">"):
        pieces.append(("f", at // size * size, piece))
        at += len(piece.encode()) + 1
    if not pieces[-1][2]:
        pieces.pop()
    frame = pd.DataFrame(pieces, columns=["file", "block", "value"])
    return set(X._join_blocks(next(X._summaries(iter([frame])))).itertuples(index=False, name=None))


@pytest.mark.parametrize("seed", range(60))
def test_random_documents_at_every_block_size(seed):
    text = document(random.Random(seed))
    want = truth(text)
    for size in [*range(1, 40), 64, 100, 10**6]:
        assert found(text, size) == want, (size, text)


def test_quoted_signs_and_block_borders(spark, tmp_path):
    text = """<top><a t="it's > x"/><a t='say ">" twice > and "more'>y</a><b u="1"><c v='/>'/></b></top>"""
    (tmp_path / "q.xml").write_text(text)
    keys = {"spark.sql.files.maxPartitionBytes": "16", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        assert X.record_tags(spark, str(tmp_path / "q.xml")) == ["a", "b"]
        for k, v in keys.items():
            spark.conf.set(k, v)
        assert X.record_tags(spark, str(tmp_path / "q.xml")) == ["a", "b"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
