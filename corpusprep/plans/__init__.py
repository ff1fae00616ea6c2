"""The registered queries, each with its check in SQL."""

from corpusprep.plans import corpus, instruction, runs

QUERIES = {**instruction.QUERIES, **corpus.QUERIES, **runs.QUERIES}
ORACLES = {**instruction.ORACLES, **corpus.ORACLES, **runs.ORACLES}
