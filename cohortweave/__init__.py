"""Cohort, linkage, enrolment, cost and modelling operators for health claims on Spark."""
