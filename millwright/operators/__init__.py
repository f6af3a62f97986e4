"""DataFrame -> DataFrame operators. None of them reads, writes or collects."""
