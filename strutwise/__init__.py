"""Strutwise: lattice-inspection analytics as Spark plans.

The package holds DataFrame operators (``operators``), readers and writers
(``sources``), column expressions (``functions``), composed analyses
(``plans``) and their streaming forms (``streaming``).
"""
