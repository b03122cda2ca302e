"""policyscan: mine rule identifiers and severities from policy pages with Spark."""

__version__ = "0.1.0"
