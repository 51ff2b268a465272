"""Where data comes from and goes to: the ``Tables`` registry, target
``schemas`` and partition columns, fixture views over the test tables, and
the ``sinks``."""
