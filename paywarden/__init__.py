"""Behavioural risk analytics for payment transactions, written for Spark."""
