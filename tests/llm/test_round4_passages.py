"""Round 4: near-duplicate lines in the middle of a band's group, by force."""

import random

from tidemark.llm import neardup, passages


def test_every_pair_of_alike_lines_is_found(spark):
    """Sixty pairs of lines of one template, only the two of a pair being alike.
    By comparison with the first and the last line of each group one pair is lost."""
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(6))
    base, lines = [word() for _ in range(120)], []
    for _ in range(60):
        own = list(base)
        for p in (20, 60, 100):
            own[p] = word()
        other = list(own)
        for p in (40, 80):
            other[p] = word()
        lines += [own, other]
    r.shuffle(lines)
    rows = [(i, " ".join(x)) for i, x in enumerate(lines)]
    alike = {(i, j) for i, a in rows for j, b in rows if i < j and neardup.similarity(a, b) >= 0.8}
    got = {x.doc_id: x for x in passages.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {x for p in alike for x in p}
    assert all(got[i].cluster == got[j].cluster and got[i].members == 2 for i, j in alike)
