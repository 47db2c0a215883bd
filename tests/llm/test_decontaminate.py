"""Spaced seeds against all substitutions that the check accepts."""

from collections import Counter
from itertools import combinations
from math import ceil

import pytest

from byteloom.llm import decontaminate


def accepted(length):
    """All sets of substituted places that leave enough of a window of an item."""
    width = min(length, decontaminate.WINDOW)
    for n in range(width - ceil(width * decontaminate.AGREE) + 1):
        yield from combinations(range(width), n)


@pytest.mark.parametrize("length", range(1, 16))
def test_masks_hit_every_accepted_window(length):
    width = min(length, decontaminate.WINDOW)
    masks = decontaminate.masks_of(length)
    assert 1 <= len(masks) <= decontaminate.MOST_MASKS
    for changed in accepted(length):
        assert any(
            all(c == "0" or at + i not in changed for i, c in enumerate(mask))
            for mask in masks
            for at in range(width - len(mask) + 1)
        )


def test_no_overlap_is_lost(spark):
    """Items of 1 to 16 words, each in a document of its own for every accepted set of substitutions."""
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 17)]
    docs, want = [], {}
    for n, text in items:
        for changed in accepted(n):
            words = [f"x{k}" if k in changed or k >= decontaminate.WINDOW else w for k, w in enumerate(text.split())]
            docs.append((len(docs), "before it " + " ".join(words) + " after it"))
            want[len(docs) - 1] = (n, 2, sum(w.startswith("i") for w in words), n)
        width = min(n, decontaminate.WINDOW)
        one_more = set(range(0, width, 2)[: width - ceil(width * decontaminate.AGREE) + 1])
        docs.append((len(docs), " ".join(f"y{k}" if k in one_more or k >= width else w for k, w in enumerate(text.split()))))
    docs += [(None, None), (-1, ""), (-2, "one")]
    got = decontaminate.overlaps(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame(items + [(90, None), (91, " .")], "item_id bigint, text string"),
    ).drop("text_key").collect()
    assert Counter(r.doc_id for r in got) == Counter(want.keys())
    assert {r.doc_id: (r.item_id, r.offset, r.matched, r.item_words) for r in got} == want
