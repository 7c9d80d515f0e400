"""Scalar column functions (F*) and SQL UDFs (U*)."""
