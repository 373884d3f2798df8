"""Readers that turn landed files and raw streams into typed rows, and table sinks."""
