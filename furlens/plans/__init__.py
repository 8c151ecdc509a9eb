"""Stages composed from the operators."""
