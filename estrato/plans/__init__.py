"""The transfer-agreements domain as a configuration of the operators."""
