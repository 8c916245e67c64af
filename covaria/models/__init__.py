"""Regression and classification models behind one fit / transform contract."""
