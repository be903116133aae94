"""Block naming against grouping by the normalised text."""

import hashlib
import random
import re

import pytest

from cinelake.llm import block_naming
from tests.llm.helpers import documents


def _norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def _want(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(_norm(t), set()).add(i)
    return {(i, min(groups[_norm(t)]), len(groups[_norm(t)]), i == min(groups[_norm(t)]), hashlib.sha256(_norm(t).encode()).hexdigest()) for i, t in rows}


@pytest.mark.parametrize("block_chars", [4, 4096])
def test_groups_equal_brute_force(spark, monkeypatch, block_chars):
    monkeypatch.setattr(block_naming.name_documents, "__defaults__", (block_chars,))
    rng = random.Random(block_chars)
    texts = ["".join(rng.choice("ab \n\té😀") for _ in range(rng.randint(0, 40))) for _ in range(30)]
    texts += ["", None, " ", "x" * 9000, "x" * 9001, "abcd", "abcdabcd", "ab cd", "ab\t\ncd"]
    rows = [(5 * i + 1, rng.choice(texts)) for i in range(200)]
    got = [tuple(r) for r in block_naming.exact_groups(documents(spark, rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert len(got) == len(rows) and set(got) == _want(rows)


def _by_rows(rows):
    """Groups of rows, whatever their ids."""
    out = []
    for i, t in rows:
        same = [j for j, u in rows if _norm(u) == _norm(t)]
        keep = min((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep, hashlib.sha256(_norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [
    [(1, "a"), (1, "a"), (2, "a"), (3, "b")],
    [(1, "aaa"), (1, "bbb"), (2, "bbb"), (3, "aaa")],
    [(5, "x" * 9000), (5, "y" * 9000), (6, "x" * 9000), (7, "y" * 9000), (7, "y" * 9000)],
    [(1, "a"), (None, "a"), (None, "only"), (None, "only"), (None, None), (4, "")],
    [(-3, "z " * 5000), (-3, "z\t" * 5000), (None, "z\n" * 5000 + "q")],
])
def test_every_row_counts(spark, rows):
    got = block_naming.exact_groups(documents(spark, rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == _by_rows(rows)
    assert block_naming.exact_groups(documents(spark, rows).where("doc_id > 9")).count() == 0


def test_only_runs_that_change_are_replaced():
    import random
    import re

    from cinelake.llm.block_naming import _RUN

    draw = random.Random(7)
    for _ in range(20_000):
        text = "".join(draw.choices("  \t\n\x0b\x0c\r\x1c\xa0ab", k=draw.randint(0, 12)))
        assert re.sub(_RUN, " ", text) == re.sub(r"[\x20\x09-\x0D]+", " ", text)
    # A space alone, nearly every one of prose, is no match.
    assert not re.search(_RUN, "a b c d") and re.findall(_RUN, "a  b\tc \n") == ["  ", "\t", " \n"]
