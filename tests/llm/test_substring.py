import pytest

from nearkin.llm import substring
from llm_helpers import frame, odd_rows, words


def brute_force(documents, n):
    """documents: (id, text) in any order, distinct. Kept words of each."""
    seen, kept = set(), {}
    for doc, text in documents:
        w = words(text)
        gone = set()
        for i in range(len(w) - n + 1):
            window = tuple(w[i: i + n])
            if window in seen:
                gone.update(range(i, i + n))
            seen.add(window)
        kept[doc, text] = [x for i, x in enumerate(w) if i not in gone]
    return kept


@pytest.mark.parametrize("n, k, seed, crowd", [(20, 8, 3, 5000), (20, 8, 4, 3), (6, 3, 5, 5), (9, 9, 6, 1), (6, 3, 7, 0)])
def test_windows_follow_the_definition(spark, n, k, seed, crowd):
    """Anchors in more than `crowd` texts go through single windows, the others through trees."""
    rows = odd_rows(seed)
    df = frame(spark, rows)
    found = substring.remove_repeats(df, n=n, k=k, group_rows=5, crowd_texts=crowd)
    assert found.columns == [*df.columns, "n_words", "n_removed", "kept"]
    found = found.collect()
    assert len(found) == len(rows)
    expected = brute_force(sorted({(r[0], r[1]) for r in rows if r[0] is not None}, key=lambda x: (x[0], str(x[1]))), n)
    for r in found:
        own = words(r.text) if r.doc_id is None else expected[r.doc_id, r.text]
        assert (r.n_words, r.n_removed, r.kept) == (len(words(r.text)), len(words(r.text)) - len(own), " ".join(own))


@pytest.mark.parametrize("crowd", [50, 5000])
def test_one_passage_in_most_documents_and_periodic_text(spark, crowd):
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, f"a{i} {passage} b{i}", None, None, None, None, None, None) for i in range(300)]
    rows += [(1000 + i, "t u " * 60, None, None, None, None, None, None) for i in range(2)]
    found = {r.doc_id: r for r in substring.remove_repeats(frame(spark, rows), crowd_texts=crowd).collect()}
    assert found[0].n_removed == 0 and all(found[i].kept == f"a{i} b{i}" for i in range(1, 300))
    assert found[1000].kept == " ".join(["t", "u"]) and found[1001].kept == ""


def test_trees_in_parts_and_empty_table(spark, monkeypatch):
    import numpy as np

    contexts = [b"a b c d e", b"x a b c d", b"b c d e f"]
    args = (np.array([3, 1, 2]), np.zeros(3, np.int64), np.array([0, 0, 0]), np.array([2, 2, 2]), contexts, 4)
    whole = substring.repeats_in_tree(*args)
    assert [tuple(x) for x in zip(*whole)] == [(0, 0), (0, 1)]
    monkeypatch.setattr(substring, "TREE_WINDOWS", 2)
    assert [x.tolist() for x in substring.repeats_in_tree(*args)] == [x.tolist() for x in whole]
    assert substring.remove_repeats(frame(spark, odd_rows()).where("false")).count() == 0
