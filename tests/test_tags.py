"""Tags over versions against dictionaries, one interest after another."""

import random

from tidemark.operators import tags as T


class _Loop:
    def __init__(self):
        self.tags, self.results, self.ledger = [], {}, {}

    def update(self, interest, wanted, version):
        active = [t for t in self.tags if t["interest"] == interest and t["status"] == "active"]
        old = [t["tag"] for t in active]
        kept = [w for w in wanted if w in old]
        kind = "first" if not old else "full" if 1 - len(kept) / len({*old, *wanted}) >= T.THRESHOLD else "incremental"
        for t in active:
            if kind == "full" or t["tag"] not in wanted:
                t["status"] = "deprecated"
                for key in self.results:
                    if key[0] == interest and key[2] == t["tag"]:
                        self.results[key] = "deprecated"
            else:
                t["priority"] = kept.index(t["tag"]) + 1
        added = [w for w in wanted if kind != "incremental" or w not in old]
        first = len(kept) if kind == "incremental" else 0
        self.tags += [{"interest": interest, "tag": w, "version": version, "status": "active", "priority": first + i} for i, w in enumerate(added, 1)]
        self.ledger = {k: v for k, v in self.ledger.items() if k[0] != interest or not (kind == "full" or (kind == "incremental" and added and not v[0]))}
        return kind

    def classify(self, interest, items, version):
        for item, words in items:
            if (interest, item) in self.ledger:
                continue
            hits = [t for t in self.tags if t["interest"] == interest and t["status"] == "active" and t["tag"] in words]
            for t in hits:
                self.results.setdefault((interest, item, t["tag"], t["version"]), "active")
            self.ledger[interest, item] = (bool(hits), version)


def test_versions(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(9)]
    items = {i: [(k, rng.sample(words, 3)) for k in range(12)] for i in ("a", "b", "c")}
    loop, s, kinds = _Loop(), T.empty(spark), set()
    flat = spark.createDataFrame([(i, k, w) for i, rows in items.items() for k, ws in rows for w in ws], "interest string, item_id long, tag string")
    before = {i: rng.sample(words, 4) for i in items}
    for version in range(4):
        wanted = {i: (rng.sample(words, 4) if rng.random() < 0.4 else [*rng.sample(before[i], 3), *rng.sample(words, 1)]) for i in items if version == 0 or rng.random() < 0.8}
        wanted = {i: list(dict.fromkeys(w)) for i, w in wanted.items()}
        before |= wanted
        for i, w in wanted.items():
            kinds.add(loop.update(i, w, version))
        s = T.updated(s, spark.createDataFrame([(i, w, p) for i, ws in wanted.items() for p, w in enumerate(ws, 1)], "interest string, tag string, p int"), version)
        asked = T.pending(s, flat.where(f"item_id < {3 * version + 3}").select("interest", "item_id").distinct())
        for i, rows in items.items():
            loop.classify(i, [x for x in rows if x[0] < 3 * version + 3], version)
        found = asked.join(flat, ["interest", "item_id"]).join(s.tags.where("status = 'active'").select("interest", "tag"), ["interest", "tag"])
        s = T.classified(s, found, asked, version)
        assert sorted(map(tuple, s.tags.collect())) == sorted(tuple(t.values()) for t in loop.tags)
        assert {(r.interest, r.item_id, r.tag, r.version): r.status for r in s.results.collect()} == loop.results
        assert {(r.interest, r.item_id): (r.matched, r.version) for r in s.ledger.collect()} == loop.ledger
    assert kinds == {"first", "full", "incremental"} and "deprecated" in loop.results.values()
