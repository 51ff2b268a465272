"""Reusable operators: spec-driven loads (``load``), UPDATE as a rewrite
(``changes``), size-checked broadcast joins (``sizing``), and skew-safe
ordered operators (``sequence``)."""
