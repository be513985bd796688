"""Part of millrace; see the package README."""
