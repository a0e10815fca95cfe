"""Spark jobs for whole-slide nuclei tables and tissue-microenvironment features."""
