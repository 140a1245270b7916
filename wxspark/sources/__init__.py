"""Tables the jobs read: generated, landed or fixed."""
