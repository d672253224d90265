"""All registered queries: name -> (callable, DuckDB SQL or None)."""

from __future__ import annotations

from cadenza.queries import labelling, modelling, preparation, streams, training

REGISTRY = {}
for module in (preparation, labelling, training, modelling, streams):
    REGISTRY.update(module.QUERIES)
