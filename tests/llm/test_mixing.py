import hashlib
from collections import Counter, defaultdict

import pytest

from footfall.llm import mixing
from tests.llm.conftest import words


def brute(rows):
    """doc ids may repeat; rows are (doc_id, text, source)."""
    size = [len(words(t)) for _, t, _ in rows]
    total = defaultdict(int)
    for (_, _, source), n in zip(rows, size, strict=True):
        total[source] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:
        open_weight = sum(weight[s] for s in order if s not in capped)
        level = (sum(total.values()) - sum(3 * total[s] for s in capped)) / open_weight if open_weight else 0
        above = {s for s in order if weight[s] * level > 3 * total[s]}
        if above <= capped:
            break
        capped |= above
    target = {s: min(3.0 * total[s], weight[s] * level) for s in order}
    taken = [0] * len(rows)
    for source in order:
        own = [i for i, r in enumerate(rows) if r[2] == source]
        length = {i: size[i] * 1024 // (size[i] + 256) for i in own}
        mean = sum(size[i] * length[i] for i in own) / total[source] if total[source] else 0.0
        ratio = target[source] / total[source] if total[source] else 0.0
        whole = int(ratio)
        share, rest = ratio - whole, target[source] - whole * total[source]
        ranked = defaultdict(list)
        for i in own:
            taken[i] = whole
            if share > 0:
                digest = hashlib.md5(f"mix:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest()
                u = (int(digest[:12], 16) + 0.5) / 2 ** 48
                p = share + min(share, 1 - share) * ((mean - length[i]) / 1024)
                q = (u / (1 - u)) / (p / (1 - p))
                ranked[q / (1 + q)].append(i)
        before = 0
        for rank in sorted(ranked):
            step = sum(size[i] for i in ranked[rank])
            if before + step >= rest and before + step - rest > rest - before:
                break
            for i in ranked[rank]:
                taken[i] += 1
            before += step
            if before >= rest:
                break
    return [(r[0], n, total[r[2]], target[r[2]], n * k) for r, n, k in zip(rows, size, taken, strict=True)]


def sorted_rows(rows):
    return sorted((str(r[0]), r[1], r[2], round(r[3], 6), r[4]) for r in rows)


@pytest.mark.parametrize("bins", [4096, 2])
def test_equals_brute_force(documents, monkeypatch, bins):
    monkeypatch.setattr(mixing, "BINS", bins)
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    found = mixing.mixture(documents).drop("copies").collect()
    assert sorted_rows(found) == sorted_rows(brute(rows))


def test_targets_are_met(documents):
    rows = mixing.mixture(documents).collect()
    by_source = defaultdict(list)
    for row, doc in zip(sorted(rows, key=lambda r: r.doc_id), documents.orderBy("doc_id").collect(), strict=True):
        by_source[doc.source].append(row)
    for own in by_source.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1
        assert own[0].target <= 3 * own[0].source_size + 1e-6
        assert all(r.taken <= 3 * r.size for r in own)
    assert abs(sum(own[0].target for own in by_source.values()) - sum(r.size for r in rows)) < 1e-3


def test_small_source_is_capped(spark):
    rows = [(i, "w " * 50, "big") for i in range(100)] + [(200, "a b", "tiny"), (201, "c", "tiny"), (300, "q " * 9, None)]
    found = mixing.mixture(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken = {r.doc_id: r.taken for r in found}
    assert taken[200] == 6 and taken[201] == 3 and taken[300] == 27
    assert abs(sum(taken[i] for i in range(100)) - (5012 - 36)) <= 25


def test_rates_match_inclusion_probabilities(spark):
    """Documents of one source differ in inclusion probability; the rates at which they are taken follow it."""
    sizes = (8, 128, 1024)
    rows = [(i, "w " * sizes[i % 3], "a") for i in range(6000)] + [(i, "w " * 1000, "b") for i in range(9000, 10500)]
    found = mixing.mixture(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    own = [r for r in found if r.doc_id < 9000]
    share = own[0].target / own[0].source_size
    assert 0 < share < 1
    length = {n: n * 1024 // (n + 256) for n in sizes}
    mean = sum(n * length[n] for n in sizes) / sum(sizes)
    wanted = {n: share + min(share, 1 - share) * (mean - length[n]) / 1024 for n in sizes}
    rates = {n: sum(r.copies for r in own if r.size == n) / 2000 for n in sizes}
    assert wanted[8] > wanted[128] + 0.05 and wanted[128] > wanted[1024] + 0.05
    assert all(abs(rates[n] - wanted[n]) < 0.035 for n in sizes), (rates, wanted)
    assert abs(sum(r.taken for r in own) - own[0].target) <= 512 + 1


def test_rows_are_repeated(documents):
    copies = {r.doc_id: r.copies for r in mixing.mixture(documents).collect()}
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    rows = mixed.collect()
    assert Counter(r.doc_id for r in rows) == Counter({k: n for k, n in copies.items() if n})
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert all(r.text == texts[r.doc_id] for r in rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    found = mixing.mixture(odd_docs).drop("copies").collect()
    assert sorted_rows(found) == sorted_rows(brute(rows))
    assert mixing.mix(odd_docs).columns == odd_docs.columns
    assert mixing.mixture(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0
    blank = mixing.mixture(odd_docs.where("doc_id <= 3")).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 3
