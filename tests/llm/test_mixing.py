from collections import defaultdict

from llm.odd import no_documents, odd_documents

from holdwright.llm.mixing import DOMAIN_WEIGHTS, LANG_WEIGHTS, OTHER, leaf_budgets, mix


def fill(budget, children):
    """[(weight, cap)] -> alloc, by handing out the shortage again and again."""
    out, open_ = [0.0] * len(children), [k for k, (w, _) in enumerate(children) if w > 0]
    while open_:
        left = budget - sum(out)
        share = {k: left * children[k][0] / sum(children[j][0] for j in open_) for k in open_}
        full = [k for k in open_ if out[k] + share[k] >= children[k][1]]
        if not full:
            for k in open_:
                out[k] += share[k]
            break
        # The fullest child first: the others' shares grow with what it leaves.
        k = min(full, key=lambda j: children[j][1] / children[j][0])
        out[k] = children[k][1]
        open_.remove(k)
        for j in open_:
            out[j] = 0.0
    return out


def expected(leaves, share, epochs):
    weights = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS}
    out = {}

    def down(keys, level, budget):
        if level == 3:
            out[keys] = budget
            return
        kids = sorted({k[: level + 1] for k in leaves if k[:level] == keys})
        caps = [sum(t for k, t in leaves.items() if k[: level + 1] == kid) * epochs for kid in kids]
        w = [weights[("domain", "lang")[level]].get(kid[-1], OTHER) if level < 2 else 1.0 for kid in kids]
        for kid, a in zip(kids, fill(budget, list(zip(w, caps, strict=True))), strict=True):
            down(kid, level + 1, a)

    down((), 0, sum(leaves.values()) * share)
    return out


def test_budgets(spark):
    leaves = {
        ("domain-0", "en", "src0"): 1000, ("domain-0", "en", "src4"): 10, ("domain-0", "fr", "src0"): 7, ("domain-1", "en", "src1"): 5,
        ("domain-2", "xx", "src2"): 400, ("domain-3", "de", "src3"): 30, ("domain-3", "es", "src7"): 300, ("domain-3", "es", "src3"): 1,
    }
    df = spark.createDataFrame([(*k, t) for k, t in leaves.items()], "domain string, lang string, source string, total long")
    for share, epochs in ((0.8, 3), (0.1, 1), (2.5, 3), (5.0, 2)):
        weights = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS, "source": None}
        got = {(r.domain, r.lang, r.source): r.budget for r in leaf_budgets(df, weights, share, epochs).collect()}
        want = expected(leaves, share, epochs)
        assert all(abs(got[k] - want[k]) <= 1 for k in leaves), (share, got, want)


def test_mix(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mix(docs, share=1.5).select("doc.doc_id", "epoch", "tokens", "domain", "lang", "source").collect()
    tokens = defaultdict(int)
    for d in docs.collect():
        tokens[(f"domain-{int(d.source[3:]) % 4}", d.lang, d.source)] += len(d.text.split())
    want = expected(tokens, 1.5, 3)
    used = defaultdict(int)
    for r in rows:
        used[(r.domain, r.lang, r.source)] += r.tokens
    largest = max(r.tokens for r in rows)
    for k, b in want.items():
        assert b - largest - 1 <= used[k] <= b + 1
    assert len({(r.doc_id, r.epoch) for r in rows}) == len(rows) and max(r.epoch for r in rows) >= 1
    epochs = defaultdict(set)
    for r in rows:
        epochs[r.doc_id].add(r.epoch)
    assert all(e == set(range(len(e))) for e in epochs.values())


def test_odd(spark):
    docs = odd_documents(spark)
    out = mix(docs, share=1.0, max_epochs=2)
    assert out.select("doc.*").columns == docs.columns and out.count() > 0
    assert mix(no_documents(spark)).count() == 0
