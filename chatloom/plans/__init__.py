"""Named query plans: each module has a QUERIES dict of name -> (function, DuckDB SQL or None)."""

from __future__ import annotations


def registry() -> dict:
    from chatloom.plans import clusters, exports, facts, metrics, parsing, texts, themes, vectors

    out: dict = {}
    for module in (metrics, facts, texts, parsing, vectors, clusters, themes, exports):
        for name, entry in module.QUERIES.items():
            if name in out:
                raise ValueError(f"two queries named {name}")
            out[name] = entry
    return out
