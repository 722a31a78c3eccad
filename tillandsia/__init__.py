"""tillandsia: a PySpark-native query package.

besides the operators for training data in ``llm`` the package carries only
what the driver contract needs: a table reader (``sources``), decimal money
helpers (``functions``), one flagship plan (``plans``) and a session builder
with scale-aware defaults (``session``).
"""

from tillandsia.plans.pricing import pricing_summary
from tillandsia.session import build_session

__all__ = ["build_session", "pricing_summary"]
