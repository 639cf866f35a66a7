"""Command line for operators: inspect and move pointers of a store.

    python -m slipway state   ROOT [--env green] [--as-of TS]
    python -m slipway promote ROOT [TABLE ...] [--src blue --dst green]
    python -m slipway swap    ROOT [TABLE ...]
    python -m slipway clone   ROOT [--keep-extra]
    python -m slipway revert  ROOT TABLE [--seconds-ago N | --as-of TS | --to last_publish]
    python -m slipway expire  ROOT [--retain-seconds N]
    python -m slipway checks  ROOT [--asset A]
    python -m slipway history ROOT [--env E] [--table T]

Every command prints one JSON document.
"""

from __future__ import annotations

import argparse
import json
import sys


def _state(store, env, as_of):
    return {t: {"seq": v.seq, "action": v.action, "row_count": v.row_count,
                "paths": list(v.paths or ()), "ts": str(v.ts)}
            for t, v in sorted(store.versions(env, as_of=as_of).items())}


def main(argv=None, spark=None) -> dict:
    p = argparse.ArgumentParser(prog="python -m slipway")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("state"); s.add_argument("root"); s.add_argument("--env", default="green")
    s.add_argument("--as-of")
    for name in ("promote", "swap"):
        s = sub.add_parser(name); s.add_argument("root"); s.add_argument("tables", nargs="*")
        s.add_argument("--src", default="blue"); s.add_argument("--dst", default="green")
    s = sub.add_parser("clone"); s.add_argument("root"); s.add_argument("--keep-extra", action="store_true")
    s.add_argument("--src", default="green"); s.add_argument("--dst", default="blue")
    s = sub.add_parser("revert"); s.add_argument("root"); s.add_argument("table")
    s.add_argument("--env", default="green"); s.add_argument("--seconds-ago", type=float)
    s.add_argument("--as-of"); s.add_argument("--to", default="previous")
    s = sub.add_parser("expire"); s.add_argument("root")
    s.add_argument("--retain-seconds", type=float, default=86400.0)
    s = sub.add_parser("compact"); s.add_argument("root"); s.add_argument("table")
    s.add_argument("--env", default="green"); s.add_argument("--target-bytes", type=int, default=1 << 30)
    s = sub.add_parser("checks"); s.add_argument("root"); s.add_argument("--asset")
    s = sub.add_parser("history"); s.add_argument("root"); s.add_argument("--env")
    s.add_argument("--table")
    args = p.parse_args(argv)

    from slipway.operators import gates as G
    from slipway.session import get_session
    from slipway.store import Store
    spark = spark or get_session()
    store = Store(spark, args.root)
    if args.cmd == "state":
        out = {"env": args.env, "tables": _state(store, args.env, args.as_of)}
    elif args.cmd in ("promote", "swap"):
        seq = getattr(store, args.cmd)(args.tables or None, args.src, args.dst)
        out = {"seq": seq, "tables": _state(store, args.dst, None)}
    elif args.cmd == "clone":
        out = {"seq": store.clone(args.src, args.dst, drop_extra=not args.keep_extra)}
    elif args.cmd == "revert":
        seq = store.revert(args.table, args.env, as_of=args.as_of,
                           seconds_ago=args.seconds_ago, to=args.to)
        out = {"seq": seq, "tables": _state(store, args.env, None)}
    elif args.cmd == "history":
        rows = (store.history(args.env, args.table)
                .select("seq", "ts", "env", "table_name", "action", "row_count", "run_key")
                .orderBy("seq", "env", "table_name").collect())
        out = {"history": [r.asDict() for r in rows]}
    elif args.cmd == "compact":
        out = {"seq": store.compact(args.env, args.table, args.target_bytes), "tables": _state(store, args.env, None)}
    elif args.cmd == "expire":
        out = {"deleted": store.expire(args.retain_seconds)}
    else:
        res = store.check_results()
        if args.asset:
            res = res.where(res.asset == args.asset)
        out = {"gate": [r.asDict() for r in G.checks_gate(res).collect()]}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
