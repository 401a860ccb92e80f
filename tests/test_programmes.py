"""Programmes of trials against a plain fold over the rows."""

import random

from assetlens.operators.measures import programme_details


def plain(rows):
    out = {}
    for asset, condition, _, nct, pr, phase, sr, status, text in sorted(rows, key=lambda r: r[2]):
        text, pr, sr = (text or "").strip(), pr or 0, sr or 0
        if (asset, condition) not in out:
            out[asset, condition] = {"ids": {nct} - {None, ""}, "phase": (pr, phase), "status": (sr, status), "info": text.strip("; ")}
            continue
        g = out[asset, condition]
        g["ids"] |= {nct} - {None, ""}
        if pr > g["phase"][0]:
            g["phase"] = (pr, phase)
        if sr > g["status"][0]:
            g["status"] = (sr, status)
        if text and text not in g["info"]:
            g["info"] = (g["info"] + "; " + text).strip("; ")
    return {k: (sorted(g["ids"]), g["phase"][1], g["status"][1], g["info"]) for k, g in out.items()}


def test_programme_details(spark):
    rng = random.Random(3)
    texts = ["alpha", "alpha beta", "beta", "", None, "lph", "gamma; alpha", "beta; x", "gamma"]
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", None]), i, rng.choice(["N1", "N2", "N3", "", None]), *rng.choice([(1, "Phase 1"), (2, "Phase 2"), (2, "Phase II"), (None, None)]),
             *rng.choice([(1, "open"), (3, "done"), (3, "ended")]), rng.choice(texts)) for i in range(120)]
    schema = "asset_key string, condition_key string, ordinal int, nct string, phase_rank int, phase string, status_rank int, status string, information string"
    got = {(r.asset_key, r.condition_key): (r.trial_ids, r.phase, r.status, r.additional_information) for r in programme_details(spark.createDataFrame(rows, schema)).collect()}
    assert got == plain(rows)
    assert programme_details(spark.createDataFrame([], schema)).collect() == []
