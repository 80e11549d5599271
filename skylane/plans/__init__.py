"""Plan-level helpers: join strategy with checked sizes, materialisation, and
composition of the operators into the full arrival pipeline."""
