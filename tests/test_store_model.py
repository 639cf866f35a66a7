"""Random operation sequences against a plain-Python model of the log."""
import random

import pytest

from slipway.store import NothingToRevert, Store


class Model:
    """Pointers as Python data: each log row is (seq, env, table, action, rows)."""

    def __init__(self):
        self.log = []

    def _add(self, rows):
        seq = len({r[0] for r in self.log}) + 1
        for env, table, action, content in rows:
            self.log.append((seq, env, table, action, content))

    def cur(self, env, table):
        rows = [r for r in self.log if r[1] == env and r[2] == table]
        return rows[-1][4] if rows else None

    def live(self, env):
        out = {}
        for _, e, t, _, c in self.log:
            if e == env:
                out[t] = c
        return {t: c for t, c in out.items() if c is not None}

    def build(self, t, ids):
        self._add([("blue", t, "build", tuple(ids))])

    def promote(self, t):
        self._add([("green", t, "publish", self.cur("blue", t))])

    def swap(self, t):
        old = self.cur("green", t)
        if old is None:
            self._add([("green", t, "publish", self.cur("blue", t))])
        else:
            self._add([("green", t, "swap", self.cur("blue", t)), ("blue", t, "swap", old)])

    def clone(self, drop_extra):
        green = self.live("green")
        if not green:
            return
        rows = [("blue", t, "clone", c) for t, c in sorted(green.items())]
        if drop_extra:
            rows += [("blue", t, "drop", None) for t in sorted(set(self.live("blue")) - set(green))]
        self._add(rows)

    def append(self, env, t, ids):
        self._add([(env, t, "append", self.cur(env, t) + tuple(ids))])

    def drop(self, env, t):
        self._add([(env, t, "drop", None)])

    def revert(self, t):
        hist = [r for r in self.log if r[1] == "green" and r[2] == t]
        pubs = [r[0] for r in hist if r[3] in ("publish", "swap")]
        if not pubs:
            raise NothingToRevert()
        before = [r for r in hist if r[0] < max(pubs)]
        if not before or before[-1][4] is None:
            raise NothingToRevert()
        self._add([("green", t, "revert", before[-1][4])])


def ids_df(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id bigint")


@pytest.mark.parametrize("seed", [1, 2])
def test_random_operations_match_model(spark, seed):
    rnd = random.Random(seed)
    store, model = Store.scratch(spark), Model()
    store.checkpoint_every = 3
    tables, next_id = ["a", "b", "c"], [0]

    def fresh_ids(n):
        out = list(range(next_id[0], next_id[0] + n))
        next_id[0] += n
        return out

    for step in range(28):
        op = rnd.choice(["build", "build", "promote", "swap", "clone", "append", "drop", "revert"])
        t = rnd.choice(tables)
        if op == "build":
            ids = fresh_ids(rnd.randint(0, 3))
            store.build({t: ids_df(spark, ids)}, env="blue"); model.build(t, ids)
        elif op in ("promote", "swap"):
            if model.cur("blue", t) is None:
                continue
            getattr(store, op)([t]); getattr(model, op)(t)
        elif op == "clone":
            drop_extra = rnd.random() < 0.5
            store.clone(drop_extra=drop_extra); model.clone(drop_extra)
        elif op == "append":
            env = rnd.choice(["blue", "green"])
            if model.cur(env, t) is None:
                continue
            ids = fresh_ids(1)
            store.append(env, t, ids_df(spark, ids)); model.append(env, t, ids)
        elif op == "drop":
            env = rnd.choice(["blue", "green"])
            store.drop(env, t); model.drop(env, t)
        else:
            try:
                model.revert(t)
            except NothingToRevert:
                with pytest.raises(NothingToRevert):
                    store.revert(t)
            else:
                store.revert(t)
        reader = store if step % 2 else Store(spark, store.root)   # cached and fresh readers
        for env in ("blue", "green"):
            got = {k: v.row_count for k, v in reader.versions(env).items()}
            want = {k: len(v) for k, v in model.live(env).items()}
            assert got == want, (seed, step, op, t, env)
    for env in ("blue", "green"):
        for t, content in model.live(env).items():
            assert sorted(r["id"] for r in store.read(env, t).collect()) == sorted(content)
