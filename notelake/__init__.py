"""notelake: analytics over large notebook corpora, written as Spark DataFrame operators."""
