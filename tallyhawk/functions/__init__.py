"""Column-expression builders: pure ``Column -> Column`` helpers that stay
inside whole-stage codegen (no Python UDFs)."""

from tallyhawk.functions.columns import *  # noqa: F401,F403
