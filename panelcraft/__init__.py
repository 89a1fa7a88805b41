"""Segmentation and inference for questionnaire tables, written as Spark jobs."""
