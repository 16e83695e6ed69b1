"""All queries of the core: name -> (function, oracle SQL or None)."""

from lexgrain.plans import chunking, corpus, enrich, evaluation, flows, graph, index, intervals, streams, verify

MODULES = [corpus, chunking, enrich, flows, graph, index, intervals, streams, verify, evaluation]


def all_queries() -> dict[str, tuple]:
    out: dict[str, tuple] = {}
    for m in MODULES:
        out.update(m.QUERIES)
    return out


def flagship(spark, sf):
    return all_queries()["temporal_status"][0](spark, sf)
