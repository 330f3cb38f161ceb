"""The near-dedup stage links word shingles that are 0.8 alike or more; the contract of op5 alone says 0.85."""

import corpus_pipeline
from tests.llm.frames import documents, prose
from tests.llm.test_minhash import shingle_set


def changed_once(seed, words):
    """A text and its copy with a word in the middle changed: (n - 9) / (n + 1) of their shingles are shared."""
    base = prose(seed, words).split()
    return " ".join(base), " ".join([*base[: words // 2], f"w{seed}", *base[words // 2 + 1 :]])


def test_stage_like_brute_force_at_four_fifths(spark):
    texts = [t for n in range(44, 70) for t in changed_once(9000 + n, n)]  # 0.778 to 0.857; 0.8 with 49 words
    rows = [(i, t, "en", "s0") for i, t in enumerate(texts)]
    sets = [shingle_set(t) for t in texts]
    likeness = {(i, j): (len(a & b), len(a | b)) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])}
    between = [p for p, (shared, all_) in likeness.items() if 80 * all_ <= 100 * shared < 85 * all_]
    assert len(between) >= 15 and any(5 * shared == 4 * all_ for shared, all_ in likeness.values())
    dropped = {i for (i, _), (shared, all_) in likeness.items() if 100 * shared >= 80 * all_}  # pairs only, no chains
    kept = corpus_pipeline.keep_one_of_near_copies(spark, documents(spark, rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(range(len(rows))) - dropped)
