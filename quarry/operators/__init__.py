"""DataFrame operators: keys, sampling/splits, indexing, columns, metrics, LM, fits, joins."""
