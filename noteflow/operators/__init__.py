"""DataFrame -> DataFrame operators.

Modules: ``order`` (global rank, cutoff keys, checked broadcast), ``clean`` (P, D),
``joins`` (J), ``agg`` (A), ``sorting`` (O), ``split`` (SP), ``sampling`` (N, U),
``labels`` (L), ``features`` (F), ``models`` (M), ``evaluate`` (E).
"""

from . import agg, clean, evaluate, features, joins, labels, models, order, sampling, sorting, split  # noqa: F401
