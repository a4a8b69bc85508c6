"""Imports every catalogue module (each registers its keys on import)."""

from barloom.plans import q_features  # noqa: F401
from barloom.plans import q_signals  # noqa: F401
from barloom.plans import q_models  # noqa: F401
from barloom.plans import q_sentiment  # noqa: F401
from barloom.plans import q_relational  # noqa: F401
from barloom.plans import q_profile  # noqa: F401
from barloom.plans import q_prep  # noqa: F401
from barloom.plans import q_ml  # noqa: F401
from barloom.plans import q_more  # noqa: F401
