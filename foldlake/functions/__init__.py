"""Scalar functions: text, residues, geometry (columns only) and alignment (Arrow UDFs)."""
