import hashlib

from hypothesis import given
from hypothesis import strategies as st

from cohortlab.llm.fingerprints import Tree, edited_pairs, edits, fingerprints, likeness, parse

from llm_samples import ODD


@given(st.text(alphabet="ab .!\n#é", max_size=200))
def test_the_tree_covers_the_text(text):
    tree = Tree(text)
    assert sum(n for _, n, _ in tree.sections) == len(text)
    root, sections = parse(str(tree))
    assert root == tree.root.hex() and sum(n for _, n, _ in sections) == len(text)
    assert str(Tree(text)) == str(tree) and likeness(parse(str(tree)), parse(str(tree))) == 1.0


def test_edits_are_located():
    a = "First line here.\nSecond line. With two sentences.\n\nNew section now.\nLast line of it.\n"
    b = a.replace("Last line", "Next line")
    spans = edits(str(Tree(a)), str(Tree(b)))
    assert spans and any(s <= a.index("Last") < e for s, e in spans) and all(s >= a.index("Last") - 16 for s, _ in spans)
    assert edits(str(Tree(a)), str(Tree(a))) == []
    assert 0.5 < likeness(parse(str(Tree(a))), parse(str(Tree(b)))) < 1


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, (k, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(t)
        edited = t[:n - n // 4] + after[:n // 4]
        fp, ed, nx = str(Tree(t)), str(Tree(edited)), str(Tree(after))
        out.append((k, n, hashlib.sha256(edited.encode()).hexdigest(), fp, ed, likeness(parse(fp), parse(ed)), likeness(parse(fp), parse(nx))))
    return sorted(out, key=repr)


def test_pairs_against_brute_force(odd):
    for parts in (1, 3, 50):
        assert sorted(map(tuple, edited_pairs(odd, partitions=parts).collect()), key=repr) == brute(ODD)


def test_one_row_and_none(odd, none):
    one = edited_pairs(odd.where("doc_id = 5")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert edited_pairs(none).count() == 0
    assert fingerprints(odd).where("doc_id = 2").first().fingerprint == str(Tree(""))
