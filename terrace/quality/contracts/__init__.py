"""Declared checks per table, by table name."""

from .gold import GOLD
from .intermediate import INTERMEDIATE
from .landed import LANDED
from .staging import STAGING

CONTRACTS = {**LANDED, **STAGING, **INTERMEDIATE, **GOLD}
