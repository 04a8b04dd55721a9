"""Training-data operators over text tables. Nothing outside this subpackage
imports it; ``__spark_entry__`` adds its queries if it is installed."""
