"""Entry points: discovery, verification and export over a store of result tables."""
