"""The operators bound to the star-schema tables, each with an independent SQL statement where SQL can say it."""

from workload.base import ORACLES, QUERIES
from workload import aggregates, decisions, features, files, functions, joining, keys, learning, quality, risk, shaping, streams
