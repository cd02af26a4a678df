"""Reports and loads per business area, composed from the operators."""
